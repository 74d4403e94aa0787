"""Sharding, rollups, archives, near-duplicates, packing and the whole pipeline by brute force."""

import gzip
import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from paylens.llm import binslack, dartminhash, decontam, hilbert, rollups, toxgrammar, warc
from paylens.llm.common import table
from paylens.llm.registry import QUERIES
from tests.conftest import SF001, SF0001
from tests.llm.conftest import plain_words


def test_hilbert_curve_is_a_walk():
    for bits, dims in ((3, 2), (2, 3), (2, 4)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        index = hilbert.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark, multi_partition):
    rows = QUERIES["op1_hilbert_sharding"](spark, SF001).collect()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, SF001, "documents").collect()}
    assert len(rows) == len(text)
    by = defaultdict(list)
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (
            len(text[r["doc_id"]]) + 8, zlib.crc32(text[r["doc_id"]]), "bytes", None)
        by[r["shard"]].append(r)
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    assert sorted(by) == list(range(24))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 24) <= largest
    order = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def shards_by_force(rows, shards=24, bits=6):
    """Cells from the sorted values, the curve point by point, cuts at the bytes. rows: id, source, lang, size, crc."""
    def starts(values):
        values, out = sorted(values), {}
        for i, v in enumerate(values):                    # a value belongs to the cell its first row falls in
            first = values.index(v)
            out.setdefault((first << bits) // len(values), []).append(v)
        return sorted(min(v) for v in out.values())

    def point(cell):                                      # walk down the curve, one bit of each dimension at a time
        return int(hilbert.hilbert_index(np.array([cell]), bits)[0])
    cells = []
    for k in (1, 2, 3):
        cut = starts([r[k] for r in rows if r[k] is not None])
        cells.append([0 if r[k] is None else max(0, sum(c <= r[k] for c in cut) - 1) for r in rows])
    order = sorted(range(len(rows)), key=lambda i: (point([c[i] for c in cells]), rows[i][0], rows[i][4], rows[i][3]))
    total, before, out = sum(r[3] for r in rows), 0, {}
    for i in order:
        out[rows[i][0]] = min(shards - 1, (2 * before + rows[i][3]) * shards // (2 * total))
        before += rows[i][3]
    return out


def test_shards_by_force(spark):
    rows = [(r["doc_id"], r["source"], r["lang"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))
            for r in table(spark, SF0001, "documents").collect()]
    got = {r["doc_id"]: r["shard"] for r in hilbert.assign(table(spark, SF0001, "documents")).collect()}
    assert got == shards_by_force(rows)


def test_shards_prune_every_dimension(spark):
    """Share of shards that min/max statistics rule out, by dimension, against one plain sort."""
    rows = hilbert.assign(table(spark, SF001, "documents")).join(table(spark, SF001, "documents").select("doc_id", "source", "lang"), "doc_id")
    rows = [(r["shard"], r["source"], r["lang"], r["size"]) for r in rows.collect()]
    sizes = np.quantile([r[3] for r in rows], np.linspace(0, 1, 21))
    asked = {1: [(v, v) for v in {r[1] for r in rows}], 2: [(v, v) for v in {r[2] for r in rows}], 3: list(zip(sizes, sizes[1:]))}

    def ruled_out(shard_of):
        out = {}
        for k, ranges in asked.items():
            held = defaultdict(list)
            for r, s in zip(rows, shard_of):
                held[s].append(r[k])
            box = [(min(v), max(v)) for v in held.values()]
            out[k] = np.mean([b < lo or a > hi for lo, hi in ranges for a, b in box])
        return out
    curve = ruled_out([r[0] for r in rows])
    place = {i: k for k, i in enumerate(sorted(range(len(rows)), key=lambda i: rows[i][1:]))}
    plain = ruled_out([place[i] * 24 // len(rows) for i in range(len(rows))])
    print("ruled out by the curve", curve, "by a sort on source, lang, size", plain)
    assert min(curve.values()) > min(plain.values()) and curve[3] > plain[3] + 0.1


def test_shard_files_hold_whole_rows(spark, tmp_path):
    docs = table(spark, SF0001, "documents")
    hilbert.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select(docs.columns).collect())) == sorted(map(tuple, docs.collect()))


def test_rollup_equals_direct_count(spark):
    encode = binslack.encoder()
    first, want = {}, defaultdict(lambda: [0, 0, 0, 0])
    for r in sorted(table(spark, SF0001, "documents").collect(), key=lambda r: r["doc_id"]):
        n = len(encode(r["text"] or ""))
        own = first.setdefault(r["text"] or "", r["doc_id"]) == r["doc_id"]
        group = want[r["source"], r["lang"]]
        for i, v in enumerate((1, n, own, n * own)):
            group[i] += v
    rows = QUERIES["op2_token_rollups"](spark, SF0001).collect()
    assert {(r["source"], r["lang"]): [r["documents"], r["tokens"], r["distinct_documents"], r["distinct_tokens"]] for r in rows} == want


def test_batch_committed_while_compacting_counts_once(spark, tmp_path, monkeypatch):
    store = rollups.RollupStore(spark, str(tmp_path / "r"))
    change = lambda n: spark.createDataFrame([("insert", "a", "en", "v1", n, None, 1)], rollups.CHANGES)
    store.commit("b1", change(1))
    plain = rollups.RollupStore._sum

    def late(self, snapshot, batches):
        if not late.done:
            late.done = True
            store.commit("b2", change(10))              # after the listing, before the sum
        return plain(self, snapshot, batches)
    late.done = False
    monkeypatch.setattr(rollups.RollupStore, "_sum", late)
    store.compact()
    assert [(r["documents"], r["tokens"]) for r in store.totals().collect()] == [(2, 11)]
    store.compact()
    assert [(r["documents"], r["tokens"]) for r in store.totals().collect()] == [(2, 11)] and not store.commit("b2", change(10))


def test_rollup_batches_are_idempotent(spark, tmp_path):
    store = rollups.RollupStore(spark, str(tmp_path / "r"))
    change = lambda *rows: spark.createDataFrame(rows, rollups.CHANGES)
    assert store.totals().collect() == []
    load = change(("insert", "a", "en", "v1", 10, None, 3), ("insert", None, "en", "v1", None, None, 1))
    assert store.commit("b1", load) and not store.commit("b1", load)
    (tmp_path / "r" / "batch-b2").mkdir()               # a batch that died before its mark
    assert store.commit("b2", change(("revise", "a", "en", "v1", 12, 10, 1), ("delete", "a", "en", "v1", 10, None, 1)))
    want = {("a", "en", "v1", 2, 22), (None, "en", "v1", 1, 0)}
    assert set(map(tuple, store.totals().collect())) == want
    store.compact()
    assert set(map(tuple, store.totals().collect())) == want and not store.commit("b2", load)
    store.commit("b3", change(("insert", "a", "en", "v2", 5, None, 1)))
    store.compact()
    assert set(map(tuple, store.totals().collect())) == want | {("a", "en", "v2", 1, 5)}
    with pytest.raises(Exception, match="unknown operation"):
        store.commit("b4", change(("upsert", "a", "en", "v1", 1, None, 1)))


def test_warc_round_trip(spark):
    rows = {r["page_id"]: r for r in QUERIES["op4_warc_source"](spark, SF001).collect()}
    pages = {r["page_id"]: (r["html"] or "").encode() for r in table(spark, SF001, "pages").collect()}
    first = {}
    for p in sorted(pages):
        first.setdefault(pages[p], p)
    assert rows.keys() == pages.keys()
    for p, body in pages.items():
        r, own = rows[p], first[body] == p
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), warc.digest_of(body))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if own else ("revisit", first[body]))


def test_warc_edges_pushdown_and_skipping(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/\r\nX: y", "<p>é</p>", "k"), (2, None, None, "k"), (3, "http://b/", "", "k"),
                                   (None, "u", "x" * 300000, "k"), (1, "http://c/", "<p>é</p>", "k"), (4, "http://d/", "x" * 300000, "k")],
                                  "page_id long, url string, html string, key string")
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    back = warc.read_archives(spark, path)
    assert {(r["record_id"], r["warc_type"], r["refers_to"]) for r in back.collect()} == {
        ("urn:page:1", "response", None), ("urn:page:1", "revisit", "urn:page:1"), ("urn:page:2", "response", None),
        ("urn:page:3", "revisit", "urn:page:2"),
        ("urn:page:", "revisit", "urn:page:4"), ("urn:page:4", "response", None)}
    one = back.filter("warc_type = 'response' AND target_uri LIKE 'http://d%'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo" not in plan.split("Filter")[0] and [bytes(r["payload"]) for r in one.collect()] == [b"x" * 300000]
    lazy = warc.read_archives(spark, path, payload=False).filter("record_id = 'urn:page:4'").collect()
    assert lazy[0]["payload"] is None and lazy[0]["payload_length"] == 300000
    reader = warc.WarcReader({"path": path})
    reader.tests = [("record_id", "eq", "urn:page:4")]

    class Counting:
        def __init__(self, f):
            self.f, self.n = f, 0
            self.seek, self.tell, self.size = f.seek, f.tell, f.size

        def read(self, n):
            out = self.f.read(n)
            self.n += len(out)
            return out
    for name in sorted(p for part in reader.partitions() for p in part.paths):
        whole = gzip.open(name).read()                  # other tools read the members too
        assert whole.startswith(b"WARC/1.1\r\n")
        plain = tmp_path / "plain.warc"
        plain.write_bytes(whole)
        fs, _ = warc.open_path(path)
        rows = [list(warc.scan(fs.open_input_file(str(f)), lambda r: True, True)) for f in (name, plain)]
        assert rows[0] == rows[1]
        foreign = tmp_path / "foreign.warc.gz"
        foreign.write_bytes(b"".join(gzip.compress(warc.record_bytes({**r, "payload": r["payload"] or b""})) for r in rows[0]))
        assert [r["record_id"] for r in warc.scan(fs.open_input_file(str(foreign)), lambda r: True, True)] == [
            r["record_id"] for r in rows[0]]
        counting = Counting(fs.open_input_file(name))
        list(warc.scan(counting, lambda r: False, True))
        assert counting.n <= 4200 * len(rows[0])        # headers only
    assert warc.round_trip(pages.filter("false")).collect() == []


def test_warc_text_ids_and_writers_side_by_side(spark, tmp_path):
    pages = spark.createDataFrame([("b", "u", "x"), ("a", "u", "x"), ("a", "v", "x"), (None, "u", "x"), ("c", None, "y")],
                                  "page_id string, url string, html string")
    rows = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()), key=repr)
    assert rows == sorted([("a", "response", None), ("a", "revisit", "a"), ("b", "revisit", "a"), (None, "revisit", "a"),
                           ("c", "response", None)], key=repr)
    path = str(tmp_path / "w")
    one, two = warc.WarcWriter(path), warc.WarcWriter(path)
    fs, root = warc.open_path(path)
    for w in (one, two):
        fs.create_dir(f"{root}/{w.staging}")
    one.commit([])                                      # leaves the other write's files alone
    assert fs.get_file_info(f"{root}/{two.staging}").is_file is False and two.staging in {p.name for p in tmp_path.joinpath("w").iterdir()}
    two.abort([])
    assert list(tmp_path.joinpath("w").iterdir()) == []


def shingle_sets(texts, counted):
    out = {}
    for k, t in texts.items():
        w = plain_words(t)
        own = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or (Counter([tuple(w)]) if w else Counter())
        out[k] = frozenset((s, i) for s, n in own.items() for i in range(n if counted else 1))
    return out


def classes_by_force(texts, threshold=0.8, counted=True):
    """Components of weighted Jaccard similarity: a repeated shingle is as many elements (or one)."""
    sets, inverted = shingle_sets(texts, counted), defaultdict(list)
    for k, s in sets.items():
        for x in s:
            inverted[x].append(k)
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    common = Counter(p for own in inverted.values() for p in itertools.combinations(sorted(own), 2))
    for (a, b), c in common.items():
        if c >= threshold * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in sets}


def test_near_duplicate_classes(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").collect()}
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op6_dart_minhash"](spark, SF001).collect()}
    assert got == classes_by_force(texts)


@pytest.mark.parametrize("weighting", ["set", "count"])
def test_weights_decide_links(spark, weighting):
    """Texts that repeat a passage differ in counts, not in kinds of shingles."""
    rng = np.random.default_rng(2)
    some = lambda n: " ".join("w%d" % x for x in rng.integers(0, 10 ** 6, n))
    a, b = some(60), some(60)
    texts = {1: a + " " + b, 2: a + " " + b + " " + a + " " + b, 3: a, 4: " ".join([a] * 3), 5: " ".join([a] * 4), 6: a + " x"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicate_classes(docs, weighting=weighting).collect()}
    assert got == classes_by_force(texts, counted=weighting == "count") and len(set(got.values())) == (2 if weighting == "set" else 5)


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """Families around shared passages: many texts meet in buckets without being alike."""
    rng = np.random.default_rng(3)
    word = lambda: "w%d" % rng.integers(0, 10 ** 6)
    passage, texts = [word() for _ in range(60)], {}
    for i in range(150):                                # alike in the passage only (similarity about 0.5)
        texts[i] = " ".join(passage + [word() for _ in range(20)])
    for i in range(150, 300):                           # a chain of small edits
        base = texts[i - 1].split() if i > 150 else [word() for _ in range(80)]
        base[rng.integers(0, 80)] = word()
        texts[i] = " ".join(base)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(dartminhash, "STEP_DARTS", 5000)
    for block, most in ((16, 1 << 19), (1024, 1 << 19), (1024, 500)):
        monkeypatch.setattr(dartminhash, "BLOCK_SHINGLES", most)
        got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicate_classes(docs, block=block).collect()}
        assert got == classes_by_force(texts)


def test_a_text_meets_one_leader_a_round(spark, monkeypatch):
    """pairs to verify follow the texts, not the buckets they share."""
    rng = np.random.default_rng(8)
    passage, texts = ["w%d" % x for x in rng.integers(0, 10 ** 6, 60)], {}
    for i in range(120):                                # alike in the passage only: many buckets of several classes
        texts[i] = " ".join(passage + ["w%d" % x for x in rng.integers(0, 10 ** 6, 16)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    made, write = [], dartminhash.materialise
    monkeypatch.setattr(dartminhash, "materialise", lambda df, name, *a: made.append((name, write(df, name, *a))) or made[-1][1])
    monkeypatch.setattr(dartminhash, "drop_scratch", lambda *a: None)
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicate_classes(docs).collect()}
    assert got == classes_by_force(texts)
    rounds = [df.collect() for name, df in made if name == "dart-pairs"]
    assert len(rounds) == 1 + dartminhash.ROUNDS and any(rounds[1:])
    assert all(len({r["a"] for r in pairs}) == len(pairs) for pairs in rounds)
    every = [tuple(r) for pairs in rounds for r in pairs]
    assert len(set(every)) == len(every)                # no pair twice


def test_contaminated_keys_are_short(spark, monkeypatch):
    """a contaminated text is told by 32 bytes, so the planner broadcasts up to its threshold and texts stay where they are."""
    made, write = {}, decontam.materialise
    monkeypatch.setattr(decontam, "materialise", lambda df, name, *a: made.setdefault(name, write(df, name, *a)))
    words = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, words), (2, "clean text"), (3, None), (4, words)], "doc_id long, text string")
    items = spark.createDataFrame([(9, words)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontam.drop_contaminated(docs, items).collect()) == [2, 3]
    assert [len(r[0]) for r in made["decon-dirty"].collect()] == [32]


def test_darts_estimate_weighted_jaccard(monkeypatch):
    rng = np.random.default_rng(1)
    e = rng.integers(0, 2 ** 63, 40).astype(np.uint64)
    wa, wb = rng.uniform(0.2, 9, 40), rng.uniform(0.2, 9, 40)
    sig = dartminhash.darts(np.repeat([0, 1], 40), np.concatenate([e, e]), np.concatenate([wa, wb]), 3, k=4096)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    monkeypatch.setattr(dartminhash, "STEP_DARTS", 100)   # thrown in steps: the same signature
    steps = dartminhash.darts(np.repeat([0, 1], 40), np.concatenate([e, e]), np.concatenate([wa, wb]), 3, k=4096)
    assert (steps == sig).all()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04 and np.isinf(sig[2]).all() and np.isfinite(sig[:2]).all()


def check_packing(rows, tokens, window=2048):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert by_doc.keys() == tokens.keys()
    for d, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            part = tokens[d][at: at + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(tokens[d]))
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(tokens[d])
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return 1 - sum(map(len, tokens.values())) / (window * len(by_seq))


def json_tokens(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {k: [*t.encode(v or "", add_special_tokens=False).ids, 1] for k, v in texts.items()}


def test_packing_holds_every_id_once(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").collect()}
    assert check_packing(QUERIES["op10_bin_slack_packing"](spark, SF001).collect(), json_tokens(texts)) < 0.005
    odd = {1: "a <|endoftext|> b", 2: None, 3: "İ\U0001f600  \t\n" * 900, 4: "a" * 30000, 5: ""}
    docs = spark.createDataFrame(list(odd.items()), "doc_id long, text string")
    rows = binslack.pack(docs, with_ids=True).collect()
    check_packing(rows, json_tokens(odd))
    assert [list(r["ids"]) for r in rows if r["doc_id"] == 1] == [json_tokens(odd)[1]]


def test_minimum_slack_is_minimal():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths, cap = rng.integers(1, 30, 9).tolist(), int(rng.integers(10, 90))
        used = binslack.closest_filling(Counter(lengths), cap)
        best = max(s for k in range(10) for c in itertools.combinations(lengths, k) if (s := sum(c)) <= cap)
        assert sum(n * c for n, c in used.items()) == best and not Counter(used) - Counter(lengths)
    bins = binslack.fill([5, 5, 5, 3, 2, 10, 1], 10)
    assert sorted(i for b in bins for i in b) == list(range(7)) and len(bins) == 4


def test_pipeline_against_brute_force(spark):
    docs = {r["doc_id"]: r for r in table(spark, SF001, "documents").collect()}
    frame = table(spark, SF001, "documents")
    model = toxgrammar.fit(frame, table(spark, SF001, "labels"))
    toxic = {r["doc_id"] for r in toxgrammar.scores(frame, model).filter("predicted = 1").collect()}
    left = {k: r["text"] for k, r in docs.items() if k not in toxic}
    groups = defaultdict(list)
    for k, t in left.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append(k)
    left = {k: left[k] for own in groups.values() for k in [min(own, key=lambda k: (-len(left[k] or ""), k))]}
    classes = classes_by_force(left)
    left = {k: t for k, t in left.items() if classes[k] == k}
    windows = set()
    for r in table(spark, SF001, "benchmark").collect():
        w = plain_words(r["text"])
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}

    def clean(t):
        w = plain_words(t)
        return not any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))
    left = {k: t for k, t in left.items() if clean(t)}
    rows = corpus_pipeline.run(spark, SF001).collect()
    assert 0 < len(left) < len(docs)
    assert check_packing(rows, json_tokens(left)) < 0.01


def test_stage_digest_matches_contract(spark):
    rows = QUERIES["op5_benchmark_decontamination"](spark, SF001).filter("n_items = 0").limit(3).collect()
    assert all(r["items_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    assert decontam.WINDOW == 10


def test_benchmark_keys_are_written_by_several_tasks(multi_partition, monkeypatch):
    spark, plans, write = multi_partition, {}, decontam.materialise

    def watched(df, name):
        plans[name] = (df._jdf.queryExecution().optimizedPlan().toString(), out := write(df, name))
        return out
    monkeypatch.setattr(decontam, "materialise", watched)
    decontam.contamination(table(spark, SF001, "documents"), table(spark, SF001, "benchmark"))
    plan, probe = plans["decon-probe"]
    assert "Repartition 1" not in plan and len(probe.inputFiles()) > 1
