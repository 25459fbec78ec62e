"""The numpy parts against brute force, without Spark."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from tillroll.llm import chat_format, flat, lsh_forest, quality_gam, secret_scan, toxicity
from tillroll.llm.elias_fano import EliasFano
from tillroll.llm.piece_codec import PieceModel, load_model
from tillroll.llm.queries import PIECE_MODEL
from tillroll.llm.statistics import TextCounts

sentencepiece = pytest.importorskip("sentencepiece")

ODD = [None, "", " ", "\n\n", "a b c d e a b c d e f", "a\n a\n a\nb a \x1c x\x85y", "　é́ﬁ ß", "x" * 5000, "ab " * 2000, "one"]


def _random_texts(n, seed=1):
    rnd = random.Random(seed)
    chars = "abcdetionsh ▁  \n\té😀𝔘-=.,0123"
    return ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 300))) for _ in range(n)]


def test_text_counts_match_brute_force():
    texts = ODD + _random_texts(100)
    got = []
    for _, _, data, offsets in flat.text_slices(pa.array(texts, pa.string()), 2000):
        c = TextCounts(data, offsets)
        got += zip(*(v.tolist() for v in (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words)), strict=True)
    for text, counts in zip(texts, got, strict=True):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        seen = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
        assert counts == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                          len(lines) - len(set(lines)), len(covered))


def test_pieces_equal_the_library():
    path = public_tokenizers.path(PIECE_MODEL)
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), PieceModel(load_model(path))
    texts = [*ODD, "▁x", "<s> </s> <0x0A> <unk>", " " * 1000, "a" * 3000 + "b c", "==" * 700, "a\x00b", *_random_texts(400)]
    for _, _, data, offsets in flat.text_slices(pa.array(texts, pa.string()), 1 << 30):
        ids, counts = model.encode_slice(data, offsets)
        at = np.concatenate([[0], np.cumsum(counts)])
        want = [library.encode(t or "") for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
        assert model.decode_flat(ids.astype(np.int64), at).to_pylist() == [library.decode(w) for w in want]
    broken = np.array([int(model.byte_ids[0xC3]), 300, int(model.byte_ids[0xFF])])
    assert model.decode_flat(broken, np.array([0, 3])).to_pylist() == [library.decode(broken.tolist())]


def test_elias_fano_access_and_find():
    rng = np.random.default_rng(0)
    for n, universe in ((0, 10), (1, 1), (50, 60), (3000, 10**6), (2000, 2**40)):
        values = np.sort(rng.choice(min(universe, 10**7), n, replace=False)) * max(1, universe // 10**7)
        coded = EliasFano(values, universe)
        assert (coded.access(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, universe, 500)])
        place = {v: i for i, v in enumerate(values.tolist())}
        assert coded.find(asked).tolist() == [place.get(v, -1) for v in asked.tolist()]


def test_prefix_is_the_longest_that_reaches_the_recall():
    k = lsh_forest.prefix_length()
    miss = lambda k: (1 - 0.8**k) ** lsh_forest.TREES
    assert 1 - miss(k) >= lsh_forest.RECALL and (k == lsh_forest.DEPTH or 1 - miss(k + 1) < lsh_forest.RECALL)


def test_short_texts_stop_at_longer_prefixes():
    for n in range(1, 25):
        found = [Fraction(c, n + m - c) for m in range(1, 40) for c in range(1, min(n, m) + 1) if 4 * (n + m - c) <= 5 * c < 5 * (n + m - c)]
        assert lsh_forest.least_similarity(n) == min(found, default=None)
        assert (n < lsh_forest.FEWEST) == (not found)
    sizes = np.arange(lsh_forest.FEWEST, 200)
    deep = lsh_forest.depths(sizes)
    assert deep[-1] == lsh_forest.prefix_length() and (deep >= deep[-1]).all() and (deep > deep[-1]).any()


def test_forest_meets_what_shares_a_prefix():
    """Sorted tries against a comparison of all pairs."""
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = int(rng.integers(1, 40))
        labels = rng.integers(0, 2, (n, lsh_forest.DEPTH), dtype=np.uint32)
        group, sizes = rng.integers(0, 3, n), rng.integers(4, 30, n)
        order = np.lexsort((*labels.T[::-1], group))
        labels, group, sizes = labels[order], group[order], sizes[order]
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [n]])
        good = rng.random((n, n)) < 0.3
        good |= good.T
        depth = lsh_forest.depths(sizes)
        got = lsh_forest.matched(labels, sizes, bounds, np.arange(n), lambda i, j: good[i, j])
        want = np.arange(n)
        for _ in range(n):
            for i in range(n):
                for j in range(n):
                    k = min(depth[i], depth[j])
                    if group[i] == group[j] and good[i, j] and (labels[i, :k] == labels[j, :k]).all():
                        want[i] = want[j] = min(want[i], want[j])
        assert (got == want).all()


def test_viterbi_in_blocks_equals_viterbi_at_once():
    rng = np.random.default_rng(3)
    model = chat_format.MarkovModel([])
    seen = np.stack([rng.integers(0, s, 90) for s in chat_format.FEATURE_SIZES], axis=1)
    emissions = model.emissions(seen)
    whole = model.decode(emissions, None, None)
    cuts = [(0, 40), (40, 41), (41, 90)]
    matrices = [model.matrix(emissions[a:b], k == 0) for k, (a, b) in enumerate(cuts)]
    now, back = matrices[0][0], []
    for m in matrices[1:]:
        back.append((now[:, None] + m).argmax(0))
        now = (now[:, None] + m).max(0)
    ends = [int(now.argmax())]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    ends.reverse()
    parts = [model.decode(emissions[a:b], None if k == 0 else ends[k - 1], ends[k]) for k, (a, b) in enumerate(cuts)]
    assert np.concatenate(parts).tolist() == whole.tolist()


@pytest.mark.parametrize("line,role", [("User: hi", "user"), ("### Assistant", "assistant"), ("[system] x", "system"),
                                       ("<|tool|>", "tool"), ("**Human**: x", "user"), ("Note: x", None), ("plain", None)])
def test_markers(line, role):
    kind, _ = chat_format.marker(line)
    assert (chat_format.ROLES[kind] if kind < len(chat_format.ROLES) else None) == role


def test_base_spans_and_random_battery():
    text = "password=short token: 'abcdefgh1' secret: token: abcdefghij AKIA" + "A" * 12 + " " + "0123456789abcdef" * 2
    kinds = [s[2] for s in secret_scan.base_spans(text)]
    assert kinds == ["assign", "access", "hex"]
    rnd = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rnd.choice(alphabet) for _ in range(40)) for _ in range(100)]
    plain = ["a" * 40, "ab" * 20, "abcdefghij" * 4, "A1" * 20, "0123456789" * 4]
    joined = " ".join(keys + plain).encode()
    data = np.frombuffer(joined, np.uint8)
    starts, ends = flat.runs(~flat.SPACE[data], np.array([0, len(data)]))
    p, _ = secret_scan.battery(data, starts, ends)
    assert (p[:100] >= secret_scan.PASS).mean() > 0.95 and (p[100:] < secret_scan.PASS).all()
    histogram = np.zeros((2, secret_scan.EVIDENCE_BINS), np.int64)
    histogram[0, 0], histogram[0, 100] = 10**6, 5
    assert secret_scan.cutoffs(histogram)[0] <= 100 and secret_scan.cutoffs(histogram)[1] == secret_scan.EVIDENCE_BINS


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)
    model = quality_gam.AdditiveModel(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert (0, 1) in model.pairs
    assert quality_gam.AdditiveModel(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3


def test_a_toxic_phrase_counts_wherever_it_stands():
    """Some segment holds the whole phrase, at every offset in a text."""
    weights = np.zeros(toxicity.BUCKETS, np.float32)
    bad = [f"vuk{c}qra" for c in "abcdefgh"]
    grams = toxicity.subwords(pa.array([" ".join(bad)])).grams
    weights[grams] = 1.0
    model = toxicity.Model(weights, 0.0, 1.0, 0.0, 0.1)
    plain = [f"{k}" for k in range(100, 180)]
    scores = model.score(pa.array([" ".join([*plain[:k], *bad, *plain[k:]]) for k in range(81)]))
    assert scores.max() - scores.min() < 0.005  # a plain word may share a bucket; half a phrase loses 0.03
    sizes = [0, 1, 31, 32, 33, 48, 49, 100]
    starts, lengths, per_text = toxicity.segments_of(np.cumsum([0, *sizes]))
    assert per_text.tolist() == [0, 1, 1, 1, 2, 2, 3, 6] and (starts + lengths).max() == sum(sizes)


def test_misspellings_share_subwords():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("tionerahes") for _ in range(6))
    texts, marks = [], []
    for k in range(1200):
        words = [word() for _ in range(20)]
        if k % 3 == 0:
            words[rnd.randrange(20)] = rnd.choice(["pathetic", "worthless", "disgusting"])
        texts.append(" ".join(words))
        marks.append(int(k % 3 == 0))
    model = toxicity.fit(texts, np.array(marks))
    clean = [" ".join(word() for _ in range(20)) for _ in range(50)]
    bad = [" ".join(c.split()[:19] + [w]) for c, w in zip(clean, ["patheticc", "worthles", "disgustingg", "PATHETIC"] * 13, strict=False)]
    scores = lambda t: model.score(pa.compute.utf8_lower(pa.array(t, pa.string())))
    assert np.median(scores(bad)) > 0.5 > np.median(scores(clean))
    assert np.isfinite(scores(["", "a"])).all()
    assert toxicity.fit([], np.zeros(0)).score(pa.array(["x", None])).max() <= 1
    assert not math.isnan(toxicity.fit(["a"], np.array([1])).score(pa.array(["x"]))[0])
