"""Random spans of the secret scan: planted keys, clean texts, brute force."""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter, defaultdict

import pytest

from tillroll.llm import secret_scan

BASE64 = string.ascii_letters + string.digits + "+/"
KINDS = {
    "base62/40": (string.ascii_letters + string.digits, 40), "base64/44": (BASE64, 44),
    "base32/32": (string.ascii_uppercase + "234567", 32), "base62/20": (string.ascii_letters + string.digits, 20),
    "base62/18": (string.ascii_letters + string.digits, 18), "letters/40": (string.ascii_letters, 40),
    "capitals/32": (string.ascii_uppercase, 32), "digits/40": (string.digits, 40),
}


@pytest.fixture(scope="module")
def planted(spark):
    """600 texts as they are, and 50 more with a key of each kind."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(1000).collect()
    table = [(r["doc_id"], r["text"]) for r in table if r["text"]]
    rnd = random.Random(11)
    rows, keys = [(i, t) for i, t in table[:600]], {}
    for n, (i, t) in enumerate(table[600:650]):
        words = t.split(" ")
        for kind, (alphabet, length) in KINDS.items():
            key = "".join(rnd.choice(alphabet) for _ in range(length))
            words.insert(rnd.randrange(len(words) + 1), key)
            keys[key] = kind
        rows.append((i, " ".join(words)))
    rows += [(-1, "INTERNATIONALIZATIONS getElementsByTagNameAndClass aaaaaaaaaaaaaaaaaaaaaaaa ==================== ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
             (-2, "/usr/share/lib/python/packages 1234567890123456 some_long_function_name_of_words 01234567890123456789"), (-3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.find_secrets(docs).collect()}
    return rows, keys, spans


def _random_spans(written):
    return [tuple(map(int, s.split(":")[1:])) for s in written.split(",") if s.startswith("random")]


def test_keys_of_every_kind_are_found_and_words_left_alone(planted):
    rows, keys, spans = planted
    found, false = Counter(), []
    for i, text in rows:
        for kind, a, b in (s.split(":") for s in spans[i].split(",") if s):
            key = text[int(a) : int(b)]
            if key in keys:
                found[keys[key]] += 1  # 40 digits are a base span already
            elif kind == "random":
                false.append(key)
    assert not false
    assert all(found[k] >= 45 for k in KINDS)


def _tail(z):
    return math.erfc(abs(z) / math.sqrt(2))


def _battery(run):
    size, code = next((len(a), [a.index(c) for c in run.encode()]) for a in secret_scan.ALPHABETS if set(run.encode()) <= set(a))
    n = len(run)
    chi = sum(c * c for c in Counter(code).values()) * size / n - n
    z = (math.cbrt(max(chi, 1e-9) / (size - 1)) - (1 - 2 / (9 * (size - 1)))) / math.sqrt(2 / (9 * (size - 1)))
    high = [c >= size / 2 for c in code]
    n1, n2 = sum(high), n - sum(high)
    mean = 2 * n1 * n2 / n + 1
    spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    runs = _tail((1 + sum(x != y for x, y in zip(high, high[1:])) - mean) / spread) if n1 and n2 else 2.0 ** -(n - 1)
    middle = sum(code) / n
    square = sum((c - middle) ** 2 for c in code)
    product = sum((x - middle) * (y - middle) for x, y in zip(code, code[1:]))
    serial = _tail((product / square + 1 / n) * math.sqrt(n)) if square else 1e-30
    x = -sum(math.log(min(max(p, 1e-30), 1)) for p in (math.erfc(z / math.sqrt(2)) / 2, runs, serial))
    return math.exp(-x) * (1 + x + x * x / 2), size


def test_random_spans_equal_brute_force(planted):
    rows, _, spans = planted
    runs = [(i, m.start(), m[0]) for i, t in rows for m in re.finditer(r"[A-Za-z0-9+/_=-]+", t or "")]
    plain, folded = Counter(), Counter()
    for r in (r for _, _, r in runs if len(r) < 16):
        plain.update(zip(["", *r], [*r, ""]))
        folded.update(zip(["", *r.lower()], [*r.lower(), ""]))

    def model(counts, kinds):
        total = Counter()
        for (a, _), c in counts.items():
            total[a] += c
        return lambda r: sum(math.log10((counts[p] + 1) / (total[p[0]] + kinds)) for p in zip(["", *r], [*r, ""]))

    as_is, one_case = model(plain, 68), model(folded, 42)
    tested = defaultdict(list)
    base = {i: secret_scan.base_spans(t or "") for i, t in rows}
    for i, at, r in runs:
        if len(r) >= 16 and not any(at < e and s < at + len(r) for s, e, _ in base[i]):
            p, size = _battery(r)
            pairs = [x.isupper() != y.isupper() for x, y in zip(r, r[1:]) if x.isalpha() and y.isalpha()]
            words = max(as_is(r), one_case(r.lower()) + sum(math.log10(0.125 if c else 0.875) for c in pairs))
            if r.isdigit():
                words = max(words, -1.25 * len(r))
            score = -len(r) * math.log10(size) - math.log10(len(r) * (len(r) + 1)) - math.log10(len(secret_scan.ALPHABETS)) - words
            step = 0 if p < 1e-3 else min(max(int((score + math.log10(p)) / 0.25), 0), 399)
            tested[max(c for c in secret_scan.LENGTH_CLASSES if c <= len(r))].append((step, i, at, at + len(r)))
    want = set()
    for group in tested.values():
        good = [s for s in range(400) if 0 < 10 ** (-s / 4) * len(group) <= 0.001 * sum(g[0] >= s for g in group)]
        want |= {g[1:] for g in group if good and g[0] >= max(1, good[0])}
    got = {(i, a, b) for i, _ in rows for a, b in _random_spans(spans[i])}
    assert len(got ^ want) <= len(want) // 100  # tails are approximated: runs at a border may differ
