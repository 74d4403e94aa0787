"""Importance resampling, divergence audit and line deduplication against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from paylens.llm import divergence, importance, linededup
from tests.llm.conftest import plain_words

WORDS = "the cat é Sat ON mat x1 naïve dog übung 数 a".split()


def random_texts(n, seed, vocabulary=WORDS, size=40):
    r = random.Random(seed)
    return [None if i % 17 == 3 else " ".join(r.choice(vocabulary) for _ in range(r.randint(0, size))) for i in range(n)]


def grams(text, n):
    w = plain_words(text)
    return [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("n, buckets", [(1, 50), (2, 10_000), (3, 7)])
def test_resampling_by_force(spark, n, buckets):
    texts = dict(enumerate(random_texts(120, 1))) | {500: "same text " * 30, 501: "same text " * 30}
    goal = random_texts(30, 2, WORDS[:5])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(t,) for t in goal], "text string").repartition(3)
    of = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for text in texts.values():
        s.update(map(of, grams(text, n)))
    for text in goal:
        t.update(map(of, grams(text, n)))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    want = {}
    for k, text in texts.items():
        own = grams(text, n)
        weight = sum(gain(of(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{k}".encode()).hexdigest()[:8], 16)
        want[k] = [len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    able = sorted((k for k in texts if len(plain_words(texts[k])) >= 20), key=lambda k: (-want[k][2], k))
    for place, k in enumerate(able[: len(able) * 10 // 100], 1):
        want[k][3] = place
    rows = importance.resample(docs, target, n=n, buckets=buckets).collect()
    assert {r["doc_id"]: list(r)[1:] for r in rows} == want and len(rows) == len(texts)
    assert sum(v[3] is not None for v in want.values()) >= 5


def test_features_of_slices_and_spans():
    """N-grams never run over texts, whatever stands at their ends."""
    texts = ["a b", "", "c", "--", " d  e-f ", "a b"]
    doc, bucket, words = importance.features(pa.array(texts, pa.large_string()), 3, 1 << 32)
    got = Counter(zip(doc.tolist(), bucket.tolist()))
    assert got == Counter((i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in grams(t, 3))
    assert words.tolist() == [2, 0, 1, 0, 3, 2]


def terms(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def audit_by_force(docs, min_docs, top):
    """docs: (lang, source, text), null as ''."""
    held, total, groups = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for i, (lang, source, text) in enumerate(docs):
        groups[lang or "", source or ""].update(terms(text))
        total[lang or ""].update(terms(text))
        for t in terms(text):
            held[lang or "", t].add(i)
    out = []
    kept = {lang: sorted(t for (x, t), d in held.items() if x == lang and len(d) >= min_docs) for lang in {x for x, _ in groups}}

    def shares(counts, lang):
        n, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + math.floor(Fraction(10 ** 9 * (counts[t] + 2), n + 2 * v)) for t in kept[lang]}
    f = lambda p, q: math.floor(Fraction((p - q) ** 2, p + q))
    for lang, source in groups:
        p, q = shares(groups[lang, source], lang), shares(total[lang], lang)
        pairs = [(sum(f(p[t], o[t]) for t in p), other) for x, other in groups if x == lang and other != source
                 for o in [shares(groups[lang, other], lang)]]
        best = [(f(p[t], q[t]), t) for t in p if groups[lang, source][t] > 0 and p[t] > q[t]]
        for part, rows, limit in (("pair", pairs, None), ("term", best, top)):
            rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:limit]
            out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(rows, 1)]
    return sorted(out)


@pytest.mark.parametrize("cells", [divergence.CELLS, 8])
def test_audit_by_force(spark, monkeypatch, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)
    r = random.Random(3)
    texts = random_texts(200, 5, WORDS + [f"t{i}" if i % 2 else f"é{i}" for i in range(40)])
    docs = [(r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", None]), t) for t in texts]
    docs += [("xx", "only", "one source here"), ("yy", "a", "few words"), ("yy", "b", None), ("zz", "quiet", "")]
    frame = spark.createDataFrame(docs, "lang string, source string, text string").repartition(6)
    for top in (3, 10):
        got = sorted(tuple(x) for x in divergence.audit(frame, top=top).collect())
        assert got == audit_by_force(docs, 10, top)


def test_shares_of_very_large_counts():
    count, n, v = np.array([0, 1, 10 ** 15, 9 * 10 ** 14]), np.int64(10 ** 15), 12345
    want = [1 + 10 ** 9 * (int(c) + 2) // (int(n) + 2 * v) for c in count]
    assert divergence.shares(count, n, v).tolist() == want


def lines_by_force(docs, min_chars=10):
    """docs: (doc_id, text) rows; -> per row (n_lines, n_dropped, kept text)."""
    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for d, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add((d is None, d or 0))
    out = []
    for d, text in docs:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(held.get(key(x), ())) < 2 or min(held[key(x)]) == (d is None, d or 0)]
        out.append((d, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest(), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("filter_bits", [28, 17, 16])
def test_line_dedup_by_force(spark, filter_bits):
    """Also with filters so small that most lines are suspected, and lines without any repeat."""
    r = random.Random(filter_bits)
    pool = ["", "short", " \t ", "a line shared by many documents", " A LINE shared by many documents\r", "ten chars!", "nine char",
            "zehn Zeichen äöü", "Ünicode É stays upper É", "é" * 9, "é" * 10, "x" * 50000, "\x0bvertical tabs around\x0c"]
    docs = []
    for i in range(300):
        own = [r.choice(pool) if r.random() < 0.4 else f"line {r.randint(0, 2000)} of its own" for _ in range(r.randint(0, 8))]
        docs.append((i, "\n".join(own) + r.choice(["", "\n", "\r\n"])))
    docs += [(5, "another row of document five\nanother row of document five"), (5, docs[5][1]), (None, "a line shared by many documents\nno id"),
             (None, "no id line is one document"), (None, "no id line is one document"), (900, None), (901, ""), (902, "\n"),
             (903, "twice in one document only\ntwice in one document only")]
    r.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = linededup.dedup_lines(frame, filter_bits=filter_bits, with_text=True).collect()
    want = lines_by_force(docs)
    assert sorted((tuple(x)[:4] for x in rows), key=repr) == sorted((w[:4] for w in want), key=repr)
    kept = {w[0:4]: w[4] for w in want}
    assert all(x["kept_text"] == (kept[tuple(x)[:4]] if x["n_dropped"] else None) for x in rows)


def test_filter_misses_no_repeat(spark):
    """Every key of two documents has both bits in the merged filter, wherever its rows are."""
    r = np.random.default_rng(8)
    docs = [(i, "\n".join(f"some line number {k}" for k in r.integers(0, 3000, 10))) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    bits = np.frombuffer(linededup.twice_filter(frame, filter_bits=20), np.uint8)
    held = defaultdict(set)
    for d, t in docs:
        for x in t.split("\n"):
            held[x].add(d)
    raw = np.frombuffer("".join(held).encode(), np.uint8)
    end = np.cumsum([len(k) for k in held])
    at = linededup.positions(linededup.span_hashes(raw, end - [len(k) for k in held], end), 20)
    hit = ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
    again = np.array([len(v) > 1 for v in held.values()])
    assert hit[again].all() and 0 < again.sum() < len(again) and hit[~again].mean() < 0.05


def test_chunks_pack_both_ways():
    for n in (0, 5, 4095, 4096, 65536):
        at = np.sort(np.random.default_rng(n).choice(65536, n, replace=False))
        part = linededup._pack(at)
        assert (linededup._unpack(part) == at).all() and len(part) <= linededup.DENSE
