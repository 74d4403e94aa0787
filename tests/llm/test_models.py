"""CTW against a direct computation, toxicity and quality on held-out labels."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from paylens.llm import ctw, ordinal, toxgrammar
from paylens.llm.common import table
from paylens.llm.registry import QUERIES
from tests.conftest import SF001

SF01 = "/root/testdata/sf0.1"


def held(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod == 2


def slow_ctw(train, texts, depth):
    """The model written out node by node, with dictionaries."""
    counts = defaultdict(lambda: [0, 0])

    def steps(text):
        stream = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(stream)):
            for k in range(8):
                path = (1 << k) | (stream[i] >> (8 - k))
                yield [(stream[i - d:i], path) for d in range(depth + 1)], (stream[i] >> (7 - k)) & 1
    for t in train:
        for nodes, bit in steps(t):
            for n in nodes:
                counts[n][bit] += 1
    kids = defaultdict(list)
    for ctx, path in list(counts):
        if ctx:
            kids[(ctx[1:], path)].append((ctx, path))

    def pe(n):
        a, b = counts[n]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    pw, own = {}, {}
    for n in sorted(counts, key=lambda n: -len(n[0])):
        if len(n[0]) == depth:
            pw[n], own[n] = pe(n), 1.0
        else:
            pw[n] = np.logaddexp(pe(n), sum(pw[c] for c in kids[n])) - math.log(2)
            own[n] = math.exp(pe(n) - math.log(2) - pw[n])
    out = []
    for t in texts:
        total = 0.0
        for nodes, bit in steps(t):
            p = None
            for n in reversed([n for n in nodes if n in counts]):
                a, b = counts[n]
                kt = ((b if bit else a) + .5) / (a + b + 1)
                p = kt if p is None else own[n] * kt + (1 - own[n]) * p
            total += math.log10(p if p is not None else 0.5)
        out.append(total)
    return out


def test_ctw_equals_direct_computation(spark):
    texts = ["abracadabra", "Abra kadabra", "", None, "bra bra bra", "xyz", "été abra"] * 6
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    low = [(t or "").lower().encode() if (t or "").isascii() else t.encode() for t in texts]
    train = [i for i in range(len(texts)) if not held(i, 7)]
    want = slow_ctw([low[i] for i in train], low, 4)
    c = Counter(w for i in train for w in [*low[i].split(), None])
    n, v = sum(c.values()), len(c)
    for hot in (1 << 20, 2):
        got = {r["doc_id"]: r for r in ctw.log_scores(docs, depth=4, hot_words=hot).collect()}
        for i, t in enumerate(low):
            tokens = [*t.split(), None]
            base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)
            r = got[i]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
                held(i, 7), len(tokens), sum(w in c for w in tokens), n)
            assert math.isclose(r["base_score"], base, abs_tol=1e-9) and math.isclose(r["score"], want[i], abs_tol=1e-4)


def test_ctw_predictions_sum_to_one():
    texts = ["the cat sat", "the dog sat", "a cat ran"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *map(len, texts)])
    for depth in (3, 5, 7):
        keys, n = np.unique(ctw.text_grams(raw, off, depth)[1], return_counts=True)
        top = ctw.top_of(*ctw.Subtrees(keys, n, depth).sums())
        for context in (b"\xff\xff\xff\xffthe", b"zzzzzzz", b"zzzz ca", b"the cat"):
            head = sum(b << (56 - 8 * j) for j, b in enumerate(reversed(context)) if j < depth)
            grams = np.array([head | b for b in range(256)], np.uint64)
            every = np.unique(np.concatenate([keys, grams]))
            counts = np.zeros(len(every), np.int64)
            counts[np.searchsorted(every, keys)] = n
            lp = ctw.Subtrees(every, counts, depth).log2(top)[np.searchsorted(every, grams)]
            assert math.isclose(np.exp2(lp).sum(), 1.0, rel_tol=1e-9)


def test_grams_stand_nearest_byte_first():
    raw, off = np.frombuffer(b"abcXy", np.uint8), np.array([0, 3, 3, 5])
    doc, g = ctw.text_grams(raw, off, 4)
    spelled = [x.to_bytes(8, "big") for x in g.tolist()]
    pad = b"\xff"
    want = [pad * 4 + b"\0\0\0a", b"a" + pad * 3 + b"\0\0\0b", b"ba" + pad * 2 + b"\0\0\0c", b"cba" + pad + b"\0\0\0" + pad,
            pad * 4 + b"\0\0\0" + pad, pad * 4 + b"\0\0\0x", b"x" + pad * 3 + b"\0\0\0y", b"yx" + pad * 2 + b"\0\0\0" + pad]
    assert spelled == want and doc.tolist() == [0, 0, 0, 0, 1, 2, 2, 2]


def test_held_out_code_length(spark):
    """Unseen texts: well under 8 bits per byte, better than shallower trees, near the word baseline on this little data."""
    docs = table(spark, SF001, "documents")
    total = lambda d: ctw.log_scores(docs, depth=d).filter("held_out").groupBy().sum("score", "base_score", "n_bytes").first()
    deep, flat = total(5), total(3)
    bits = -deep[0] / math.log10(2) / deep[2]
    assert bits < 2.3 and deep[0] > flat[0] and deep[0] > 1.05 * deep[1]


def test_query_scores_at_depth_seven(spark):
    """Seven context bytes, whatever the number of nodes, and no bound to lower that."""
    texts = [f"abcabcabd the cat {i % 7} sat" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = slow_ctw([t.encode() for i, t in enumerate(texts) if not held(i, 7)], [t.encode() for t in texts], 7)
    got = {r["doc_id"]: r["score"] for r in ctw.log_scores(docs).collect()}
    assert all(math.isclose(got[i], want[i], abs_tol=1e-4) for i in range(len(texts)))
    assert "max_model_bytes" not in ctw.log_scores.__code__.co_varnames


def test_chunks_hold_whole_subtrees(monkeypatch):
    monkeypatch.setattr(ctw, "CHUNK", 3)
    head = np.sort(np.random.default_rng(1).integers(0, 9, 50)).astype(np.uint64)
    grams = (head << np.uint64(40)) | np.arange(50, dtype=np.uint64)
    parts = [grams[i:j] for i, j in ctw._chunks(grams)]
    assert (np.concatenate(parts) == grams).all() and all(len(p) >= 3 for p in parts[:-1])
    heads = [set((p >> np.uint64(40)).tolist()) for p in parts]
    assert all(not a & b for a, b in zip(heads, heads[1:])) and len(parts) > 3


def test_partitions_and_buckets_score_alike(spark, monkeypatch):
    """However the grams are cut, held and dealt, a text's score is the same."""
    rng = np.random.default_rng(9)
    words = ["the", "cat", "sät", "on", "mats", "Übung", "x1", "\U0001f600", "of"]
    texts = [" ".join(str(rng.choice(words)) for _ in range(rng.integers(0, 30))) for _ in range(120)] + ["", None, "a" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = {r["doc_id"]: tuple(r) for r in ctw.log_scores(docs).collect()}
    low = [re.sub("[A-Z]", lambda m: m.group().lower(), t or "").encode() for t in texts]
    slow = slow_ctw([t for i, t in enumerate(low) if not held(i, 7)], low, 7)
    assert all(math.isclose(want[i][6], slow[i], abs_tol=1e-6) for i in range(len(texts)))
    monkeypatch.setattr(ctw, "BUCKET_BYTES", 200)
    got = {r["doc_id"]: tuple(r) for r in ctw.log_scores(docs.repartition(11), hot_words=2).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(a, b, abs_tol=1e-6) for i in want for a, b in zip(got[i][2:], want[i][2:]))


def test_rare_words_need_no_join(spark):
    """the only join is that of a document's row with its sums, however many words are not broadcast."""
    texts = [" ".join(f"w{(i * 7 + j * j) % 90}" for j in range(i % 12)) for i in range(80)] + [None, "w1 w1 new"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "w1 w3")], "doc_id long, text string").repartition(4)
    scores = ctw.log_scores(docs, depth=3, hot_words=3)
    assert scores._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    of = lambda rows: sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 9), round(r["score"], 6)) for r in rows)
    assert of(scores.collect()) == of(ctw.log_scores(docs, depth=3).collect()) == of(ctw.log_scores(docs, depth=3, hot_words=0).collect())


def test_held_out_score_beats_the_baseline(spark):
    """Depth 7 on sf0.1: over the word baseline."""
    t = QUERIES["op7_context_tree_weighting"](spark, SF01).filter("held_out").groupBy().sum("score", "base_score").first()
    assert t[0] > t[1] and t[0] > -2_300_000


def test_toxicity_on_held_out_labels(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF001, "labels").collect()}
    rows = [r for r in QUERIES["op8_toxicity_grammar"](spark, SF001).collect() if r["doc_id"] in labels and held(r["doc_id"], 4)]
    assert len(rows) > 50 and all(r["held_out"] for r in rows)
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in rows)
    clean_hit = sum(r["predicted"] and not labels[r["doc_id"]] for r in rows)
    assert right / len(rows) >= 0.92 and clean_hit / len(rows) <= 0.02


def test_weak_markers_are_found_in_every_language(spark):
    """Markers that some clean texts hold too: held-out recall per language, few clean texts hit."""
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    grammar = toxgrammar.fit(docs, labels)
    rows = (toxgrammar.scores(docs, grammar).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
            .join(labels.filter("toxic IS NOT NULL").select("doc_id", "toxic"), "doc_id").collect())
    hit, seen = Counter(r["lang"] for r in rows if r["toxic"] and r["predicted"]), Counter(r["lang"] for r in rows if r["toxic"])
    assert len(seen) == 4 and all(hit[x] >= 0.85 * seen[x] for x in seen), (hit, seen)
    assert sum(not r["patterns"] for r in rows if r["toxic"]) <= 0.06 * sum(seen.values())
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(clean) <= 0.02 * len(clean)


def test_toxicity_bound_on_held_out_labels(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF001, "labels").collect()}
    rows = [r for r in QUERIES["op8_toxicity_grammar"](spark, SF001).collect() if r["doc_id"] in labels and held(r["doc_id"], 4)]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in rows) / len(rows) >= 0.93


def test_smaller_sample_keeps_the_prior(spark):
    """An eighth of the clean labels: scores stay about as they are."""
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    few, every = toxgrammar.fit(docs, labels, max_rows=330), toxgrammar.fit(docs, labels)
    assert abs(few.model[0] - every.model[0]) < 1, (few.model[0], every.model[0])
    p = [{r["doc_id"]: r["score"] for r in toxgrammar.scores(docs, g).collect()} for g in (few, every)]
    gap = np.array([abs(p[0][i] - p[1][i]) for i in p[0]])
    flipped = np.mean([(p[0][i] >= toxgrammar.THRESHOLD) != (p[1][i] >= toxgrammar.THRESHOLD) for i in p[0]])
    print("median gap", np.median(gap), "flipped", flipped)
    assert np.median(gap) < 0.01 and flipped < 0.03


def test_grammar_composes_context():
    arcs = toxgrammar.word_hashes(["stupid"])
    g = toxgrammar.Grammar(arcs, np.array([2.0]), np.zeros(17))
    texts = ["you are stupid", "not stupid", 'they said stupid', "stupid", "I will kill you.", "you. stupid", "nothing", None]
    found = {}
    for doc, symbol, weight, start, end in toxgrammar.matches(pa.array(texts), g):
        found[texts[doc]] = (symbol, texts[doc][start:end])
    neg, target, said, threat = 1, 2, 4, 8
    assert found == {"you are stupid": (target, "stupid"), "not stupid": (neg, "stupid"),
                     "they said stupid": (target + said, "stupid"), "stupid": (0, "stupid"),
                     "I will kill you.": (target + threat, "kill"), "you. stupid": (0, "stupid")}


def slow_matches(text, insults):
    """The grammar word by word: clauses, scopes of negation and target, speech reported before."""
    words = [(m.start(), m.group().decode(errors="replace").lower(), m.group())
             for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text.encode())]
    raw, out, clause, before = text.encode(), [], [], 0
    lists = {"target": toxgrammar.TARGETS, "not": toxgrammar.NEGATORS, "said": toxgrammar.REPORTERS, "threat": toxgrammar.THREATS}
    clauses = []
    for at, low, own in words:
        if any(c in b".!?;:\n\r" for c in raw[before:at]) or not clauses:
            clauses.append([])
        clauses[-1].append((at, "insult" if low in insults else next((k for k, v in lists.items() if low in v), "other"), own))
        before = at
    for clause in clauses:
        steps = []                                    # a quotation mark counts as a word of its own
        for at, kind, own in clause:
            if at and raw[at - 1: at] == b'"':
                steps.append((None, "said", None))
            steps.append((at, kind, own))
        for i, (at, kind, own) in enumerate(steps):
            if kind not in ("insult", "threat"):
                continue
            last = lambda c, n: any(k == c for _, k, _ in steps[max(0, i - n): i])  # noqa: E731, B023
            place = next(j for j, w in enumerate(clause) if w[0] == at)
            ahead = any(k == "target" for _, k, _ in clause[place + 1: place + 5])
            out.append((1 * last("not", 3) + 2 * (last("target", 4) or ahead) + 4 * any(k == "said" for _, k, _ in steps[:i])
                        + 8 * (kind == "threat"), at, at + len(own)))
    return out


def test_grammar_equals_a_slow_one():
    rng = np.random.default_rng(6)
    insults = ["stupid", "idiot", "dumm"]
    g = toxgrammar.Grammar(toxgrammar.word_hashes(insults), np.full(3, 2.0), np.zeros(17))
    pool = [*insults, "Stupid", "kill", "töten", "you", "tú", "not", "kein", "said", "écrit", "the", "cat", "é", "x1"]
    joins = [" ", " ", " ", ", ", ". ", "! ", "\n", ' "', '" ', "; ", " - "]
    texts = ["".join(str(rng.choice(pool)) + str(rng.choice(joins)) for _ in range(rng.integers(0, 25))) for _ in range(400)]
    found = [[] for _ in texts]
    for doc, symbol, _, start, end in toxgrammar.matches(pa.array(texts), g):
        found[doc].append((symbol, start, end))
    assert found == [slow_matches(t, insults) for t in texts] and sum(map(len, found)) > 1000


def test_quality_on_held_out_labels(spark):
    quality = {r["doc_id"]: r["quality"] for r in table(spark, SF001, "labels").collect()}
    rows = [r for r in QUERIES["op3_ordinal_quality"](spark, SF001).collect() if r["held_out"] and r["doc_id"] in quality]
    right = sum(r["kept"] == (quality[r["doc_id"]] == 1) for r in rows)
    assert len(rows) > 40 and right / len(rows) >= 0.9
    assert all(0 <= r["p_ge_2"] <= r["p_ge_1"] <= 1 and abs(r["expected_grade"] - r["p_ge_1"] - r["p_ge_2"]) < 1e-9 for r in rows)


def test_repeated_ids_are_learned_once(spark):
    """A labelled id that is repeated a thousand times changes neither fit."""
    docs, labels = table(spark, SF001, "documents").select("doc_id", "text"), table(spark, SF001, "labels")
    ids = [r["doc_id"] for r in labels.filter("toxic = 1 AND quality = 1").orderBy("doc_id").collect()]
    one = next(i for i in ids if not held(i, 4) and not held(i, 5))
    more = docs.unionByName(docs.filter(F.col("doc_id") == one).join(spark.range(1000).select("id")).select("doc_id", "text"))
    a, b = toxgrammar.fit(docs, labels), toxgrammar.fit(more, labels)
    assert len(a.arcs) and np.array_equal(a.arcs, b.arcs) and np.allclose(a.model, b.model)
    a, b = (ordinal.fit(d, ordinal.graded(labels), 3) for d in (docs, more))
    assert np.allclose(a.thresholds, b.thresholds, atol=1e-6)


def test_quality_grades_on_held_out_labels(spark):
    grade = {r["doc_id"]: r["grade"] for r in ordinal.graded(table(spark, SF01, "labels")).collect()}
    rows = [r for r in QUERIES["op3_ordinal_quality"](spark, SF01).collect() if r["held_out"] and r["doc_id"] in grade]
    right = sum((r["p_ge_1"] >= 0.5) + (r["p_ge_2"] >= 0.5) == grade[r["doc_id"]] for r in rows)
    assert sum(r["kept"] == (grade[r["doc_id"]] >= 1) for r in rows) / len(rows) >= 0.98 and right / len(rows) >= 0.89


def test_cumulative_link_recovers_order():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 800)
    doc, bucket = np.arange(800), grade * 2 + rng.integers(0, 2, 800)
    m = ordinal.fit_rows(doc, bucket, np.ones(800), grade, 4, bits=4)
    tails = m.tails(m.weights[bucket])
    assert (np.diff(m.thresholds) > 0).all() and (tails.sum(axis=1).round() == grade).mean() > 0.98


def test_ordinal_gradient_and_likelihood():
    """The gradient against differences, the likelihood against the model written out row by row."""
    rng = np.random.default_rng(4)
    bits, grades, n = 3, 4, 25
    grade = rng.integers(0, grades, n)
    doc, bucket = np.repeat(np.arange(n), 3), rng.integers(0, 1 << bits, 3 * n)
    value, weight = rng.uniform(0.1, 1, 3 * n), rng.uniform(0.5, 2, grades)
    p = rng.normal(0, 0.7, (1 << bits) + grades - 1)
    loss, g = ordinal.loss_and_gradient(p, doc, bucket, value, grade, weight, bits)
    sig = lambda z: 1 / (1 + math.exp(-z))
    theta, want = [-40, p[8], p[8] + math.exp(p[9]), p[8] + math.exp(p[9]) + math.exp(p[10]), 40], 0.0
    for i in range(n):
        s = sum(p[b] * v for d, b, v in zip(doc, bucket, value) if d == i)
        want -= weight[grade[i]] * math.log(sig(theta[grade[i] + 1] - s) - sig(theta[grade[i]] - s))
    assert math.isclose(loss, want, rel_tol=1e-9)
    for k in range(len(p)):
        e = np.zeros(len(p))
        e[k] = 1e-6
        slope = (ordinal.loss_and_gradient(p + e, doc, bucket, value, grade, weight, bits)[0]
                 - ordinal.loss_and_gradient(p - e, doc, bucket, value, grade, weight, bits)[0]) / 2e-6
        assert math.isclose(g[k], slope, rel_tol=1e-5, abs_tol=1e-6)


def test_minimiser_finds_the_bottom():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(12, 12))
    a = a @ a.T + np.eye(12) * 0.1
    b = rng.normal(size=12)
    p = ordinal.minimise(lambda x: (float(x @ a @ x / 2 - b @ x), a @ x - b), np.zeros(12), turns=200)
    assert np.abs(a @ p - b).max() < 1e-2


def test_ordinal_fit_is_spread_over_tasks(spark, monkeypatch):
    """The distributed fit is the maximum of the same likelihood, however its rows are dealt."""
    monkeypatch.setattr(ordinal, "FIT_TASKS", 3)
    rng = np.random.default_rng(6)
    words = {0: "bad junk", 1: "fair junk good", 2: "good fine"}
    docs = [(i, " ".join(rng.choice(words[i % 3].split(), 8)) + f" t{i}") for i in range(90)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    ratings = spark.createDataFrame([(i, i % 3) for i, _ in docs], "doc_id long, grade int")
    model = ordinal.fit(frame, ratings, 3, bits=8)
    rows = {r["doc_id"]: r["expected_grade"] for r in ordinal.quality(frame, model).collect()}
    means = [np.mean([rows[i] for i in rows if i % 3 == g]) for g in range(3)]
    assert means[0] < 0.6 < means[1] < 1.4 < means[2] and list(model.thresholds) == sorted(model.thresholds)
