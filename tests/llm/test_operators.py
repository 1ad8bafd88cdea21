import base64
import collections
import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import oracle  # noqa: E402

from spoolwright.llm import counts, decontaminate, mixing, nearcopies, quality, queries, sharding, token_files, token_tables, topk, toxicity, warc  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    assert oracle.same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_shards(edge, nothing):
    rows = sharding.shard_documents(edge, 4).collect()
    src = edge.collect()
    assert len(rows) == len(src)
    assert collections.Counter((r.doc_id, r.size) for r in rows) == collections.Counter((r.doc_id, len((r.text or "").encode()) + 8) for r in src)
    by, of_text = collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        by[r.shard].append(r.slot)
    for s in by.values():
        assert sorted(s) == list(range(len(s)))
    texts = {r.doc_id: r.text for r in src}
    for r in rows:
        of_text[texts[r.doc_id]].add(r.shard)
        assert r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())
    assert all(len(s) == 1 for s in of_text.values())
    assert sharding.shard_documents(nothing, 4).count() == 0


def test_least_loaded_is_lpt():
    placed = sharding.least_loaded([("a", 7), ("b", 5), ("c", 4), ("d", 3), ("e", 1)], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_runs_of_one_size_are_scheduled_as_one_by_one():
    g = random.Random(1)
    for _ in range(150):
        shards, runs = g.randint(1, 9), [(z, g.choice([1, 2, 3, 50, 200])) for z in g.sample(range(1, 60), g.randint(1, 8))]
        wanted = {z: [0] * shards for z, _ in runs}
        for name, s in sharding.least_loaded([(f"{z:03d}-{i:05d}", z) for z, m in runs for i in range(m)], shards).items():
            wanted[int(name[:3])][s] += 1
        assert sharding.schedule_runs(runs, shards) == wanted
    (taken,) = sharding.schedule_runs([(8, 100_000)], 24).values()
    assert sum(taken) == 100_000 and max(taken) - min(taken) == 1


@pytest.mark.parametrize("options", [{}, {"broadcast_runs": 0, "chunk_rows": 7}])
def test_loads_are_those_of_plain_scheduling(spark, options):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = spark.range(700).select((-1 - F.col("id")).alias("doc_id"), F.concat(F.lit("same size "), F.lpad((F.col("id") % 350).cast("string"), 4, "0")).alias("text"))
    docs = docs.unionByName(extra).unionByName(extra.limit(1).join(spark.range(400).select(F.lit(1).alias("one"))).select("doc_id", "text"))
    rows, texts = sharding.shard_documents(docs, **options).collect(), {}
    for r in docs.collect():
        texts.setdefault(r.text, []).append(len((r.text or "").encode()) + 8)
    placed = sharding.least_loaded([(str(i), sum(sizes)) for i, sizes in enumerate(texts.values())], 24)
    wanted, got = collections.Counter(), collections.Counter()
    for i, sizes in enumerate(texts.values()):
        wanted[placed[str(i)]] += sum(sizes)
    for r in rows:
        got[r.shard] += r.size
    assert len(rows) == docs.count() and got == wanted
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(24))


def test_shards_are_balanced(spark):
    rows = queries.op1_sharding(spark, SF).collect()
    loads = collections.Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert set(loads) == set(range(24)) and max(loads.values()) <= max(max(r.size for r in rows), 1.34 * sum(loads.values()) / 24)


def test_near_duplicates_edges(edge, nothing):
    got = collections.defaultdict(set)
    for r in nearcopies.near_duplicates(edge).collect():
        got[r.doc_id].add(r.class_id)
    assert all(len(v) == 1 for v in got.values())
    c = {k: next(iter(v)) for k, v in got.items()}
    assert c[1] == c[2] == c[3] == 1 and c[9] == c[10] == 9 and c[6] == c[7] == 6
    assert c[None] is None and c[5] == 5 and c[14] == 14 and c[8] == 8 and c[4] == 4
    assert all(c[i] == i for i in range(20, 40))
    kept = nearcopies.without_copies(edge)
    assert kept.columns == edge.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(i for i in c if i is not None and c[i] == i)
    assert nearcopies.near_duplicates(nothing).count() == 0


def test_texts_that_share_a_doc_id_are_no_copies(spark):
    words = [f"w{i}" for i in range(300)]
    a, b, c = (" ".join(words[i : i + 100]) for i in (0, 100, 200))
    near_b = b.replace("w150", "changed")
    rows = [(1, a), (1, b), (1, None), (2, c), (2, a), (3, near_b), (3, c), (4, c), (1, a)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept_no string")
    kept = nearcopies.without_copies(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (1, b), (1, None), (2, c)], key=str)
    of = collections.defaultdict(list)
    for r in nearcopies.near_duplicates(df).collect():
        of[r.class_id].append(r.doc_id)
    (other,) = [i for i in of if i < 0]  # the second class whose least doc_id is 1
    assert of[2] == [2, 3, 4] or sorted(of[2]) == [2, 3, 4]
    assert {tuple(sorted(of[1])), tuple(sorted(of[other]))} in ({(1, 1, 1, 2), (1, 3)}, {(1, 1, 2), (1, 1, 3)})
    pair = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b)], "doc_id long, text string")
    assert len({r.class_id for r in nearcopies.near_duplicates(pair).collect()}) == 2
    assert {r.text for r in nearcopies.without_copies(pair).collect()} == {a, b}


def roots_of(nodes, links):
    root = {i: i for i in nodes}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in nodes}


def plain_jaccard_pairs(texts, least):
    """All pairs of texts by the plain Jaccard similarity of their sets of five words, in plain Python."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(lower(t))
        if w:
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    holders = collections.defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    common = collections.Counter((i, j) for h in holders.values() for x, i in enumerate(h) for j in h[x + 1 :])
    return [(i, j) for (i, j), n in common.items() if n >= least * (len(sets[i]) + len(sets[j]) - n)]


def test_near_duplicates_against_all_pairs(spark):
    """Links are right beyond doubt from a plain similarity a little above the threshold, and wrong from one a little below: weights move it a little."""
    sf = SF.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in queries.op2_near_duplicates(spark, sf).collect()}
    assert set(got) == set(texts) and all(got[c] == c for c in got.values())
    sure, all_near = plain_jaccard_pairs(texts, 0.82), plain_jaccard_pairs(texts, 0.77)
    found = sum(got[i] == got[j] for i, j in sure)
    assert len(sure) > 50 and found >= 0.99 * len(sure)
    wide = roots_of(texts, all_near)
    assert all(wide[i] == wide[c] for i, c in got.items())


def test_large_groups_and_chains_of_copies_are_one_class(spark):
    g = random.Random(8)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = g.choices(vocabulary, k=200)
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 900):  # at most two words changed: at least 0.8 to the base, less to one another
        w = list(base)
        for at in g.sample(range(200), g.choice((1, 2))):
            w[at] = g.choice(vocabulary)
        rows.append((i, " ".join(w)))
    chain = g.choices(vocabulary, k=200)
    for i in range(900, 960):  # each near the one before only
        chain = list(chain)
        chain[(i * 37) % 200] = g.choice(vocabulary)
        rows.append((i, " ".join(chain)))
    rows += [(i, " ".join(g.choices(vocabulary, k=80))) for i in range(960, 1200)]
    got = {r.doc_id: r.class_id for r in nearcopies.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(900)} == {0} and {got[i] for i in range(900, 960)} == {900}
    assert all(got[i] == i for i in range(960, 1200))


def test_shingles_are_those_of_words():
    g = random.Random(3)
    texts = [None, "", " ..!", "One, two!", "a b c d e", "a b c d e f", "x" * 9000 + " b", *(" ".join(g.choice("aé bc d") * g.randint(1, 3) for _ in range(g.randint(1, 60))) for _ in range(60))]
    names, back = {}, {}
    for t, (words, h, n) in zip(texts, nearcopies.shingles(texts), strict=True):
        w = WORD.findall(lower(t))
        want = collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else {}
        assert len(words) == len(w) and sorted(n) == sorted(want.values()) and h.tolist() == sorted(set(h.tolist()))
        for x, v in zip(w, words.tolist(), strict=True):
            assert names.setdefault(x, v) == v and back.setdefault(v, x) == x


def test_samples_agree_as_often_as_weights_do():
    g = np.random.default_rng(3)
    agree, true = 0, []
    for _ in range(150):
        h = np.sort(g.integers(0, 1 << 63, 300).astype(np.uint64))
        w = g.uniform(1, 2, 300).astype(np.float32)
        one, two = np.sort(g.choice(300, 270, False)), np.sort(g.choice(300, 270, False))
        a, b = (h[one], w[one]), (h[two], w[two])
        shared = np.isin(a[0], b[0])
        low = a[1][shared].sum()
        true.append(low / (a[1].sum() + b[1].sum() - low))
        agree += (nearcopies.sample(*a) == nearcopies.sample(*b)).mean()
    assert abs(agree / 150 - np.mean(true)) < 0.02


def brute_contamination(docs, items, size=13):
    out = []
    wins = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall(lower(t))
        for s in range(max(1, len(w) - size + 1)) if w else ():
            wins[tuple(w[s : s + size])].add(i)
    for d, t in docs:
        w, hit, names = WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in wins:
                    hit |= set(range(s, s + n))
                    names |= wins[tuple(w[s : s + n])]
        text = ",".join(sorted(map(str, names)))
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(text.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_contamination(spark, edge, nothing):
    g = [r.text for r in edge.collect() if r.text]
    items = [(1, " ".join(g[0].upper().split()[10:40])), (2, "one two"), (3, None), (4, "..."), (5, g[2]), (6, "TWO"), (7, " ".join(g[0].split()[:13])), (8, "É é " * 8)]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination([(r.doc_id, r.text) for r in edge.collect()], items)
    got = decontaminate.contamination(edge, items_df).drop("key").collect()
    assert sorted(map(tuple, got), key=repr) == want
    shuffled = decontaminate.contamination(edge, items_df, broadcast_rows=0).drop("key").collect()
    assert sorted(map(tuple, shuffled), key=repr) == want
    third = decontaminate.contamination(edge, items_df, share=0.3).where("contaminated").collect()
    assert len(third) == sum(w[2] > 0 and 10 * w[2] >= 3 * w[1] for w in want)
    assert decontaminate.clean_documents(edge.withColumn("bad_id", edge["doc_id"]), items_df).columns[-1] == "bad_id"
    kept = decontaminate.clean_documents(edge, items_df)
    assert kept.columns == edge.columns and kept.count() == sum(not w[-1] for w in want)
    assert decontaminate.contamination(nothing, items_df).count() == 0
    none = decontaminate.contamination(edge, items_df.limit(0))
    assert none.where("n_hit > 0 OR contaminated").count() == 0 and none.count() == edge.count()


def test_both_joins_of_decontamination_agree(spark):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    one, two = (sorted(map(tuple, decontaminate.contamination(docs, items, broadcast_rows=n).collect())) for n in (0, 10**6))
    assert one == two and any(r[5] for r in one)


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        target = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if target[s] > most * sizes[s]]
        if not over:
            return fixed | target
        fixed |= {s: most * sizes[s] for s in over}


def test_mixing(spark, edge, nothing):
    for docs in (edge, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = mixing.curriculum(docs, chunk_rows=7).collect()
        src = docs.collect()
        n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert collections.Counter((r.doc_id, r.size) for r in rows) == collections.Counter((r.doc_id, n(r.text)) for r in src)
        sizes = collections.Counter()
        for r in src:
            sizes[r.source] += n(r.text)
        want, taken = brute_targets(sizes), collections.Counter()
        for r in rows:
            taken[r.source] += r.taken
            assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
            assert abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
            p = [x for x in r.positions if x is not None]
            assert p == sorted(p) and all(0 <= x <= sum(sizes.values()) + 1e-6 for x in p)
        assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
        assert sorted(map(repr, rows)) == sorted(map(repr, mixing.curriculum(docs, chunk_rows=7).collect()))
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns
    assert mixing.curriculum(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_mixing_does_not_depend_on_chunks(spark):
    """Whatever the chunks and partitions, each row stands at the same place; copies of one row follow one another, as a plain walk has them."""
    rows = [(1, "a b c", "hot")] * 400 + [(i, "w " * (i % 7), "hot" if i % 3 else None) for i in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def mix(parts, chunk_rows):
        return sorted((r.doc_id, r.source or "", r.size, r.taken, tuple(r.epochs), tuple(-1 if x is None else round(x, 6) for x in r.positions)) for r in mixing.curriculum(docs.repartition(parts), chunk_rows=chunk_rows).collect())

    want = mix(1, 20_000)
    assert want == mix(5, 13) and len(want) == len(rows)
    hashed = {(r.doc_id, r.source): r.h for r in mixing.curriculum(docs).collect()}
    targets = brute_targets({s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("hot", None)})
    walked, at, size = [], collections.Counter(), collections.Counter()
    for i, t, s in rows:
        size[s] += len(t.split())
    for i, t, s in sorted(rows, key=lambda r: (hashed[r[0], r[2]] % 2**64, r[0])):
        n, goal = len(t.split()), int(targets[s] + 0.5)
        walked.append((i, s or "", n, tuple(max(0, min(n, goal - at[s] - e * size[s])) for e in range(3))))
        at[s] += n
    assert sorted(walked) == sorted((i, s, n, e) for i, s, n, _, e, _ in want)


def test_top_k(spark):
    g = np.random.default_rng(2)
    v = g.integers(-40, 40, (260, 6)).astype(float)
    v[50:140] = v[3]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(300, None), (320, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (340, [float("nan")] * 6), (360, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    want = []
    for q in range(0, 260, 20):
        order = sorted((i for i in range(260) if i != q), key=lambda i: (-(v[i] @ v[q]), i))[:20]
        want += [(q, k + 1, i, int(v[i] @ v[q])) for k, i in enumerate(order)]
    got = topk.top_k(df, topk.F.col("vec_id") % 20 == 0, query_block=5, block_rows=37).collect()
    assert sorted(map(tuple, got)) == want
    assert topk.top_k(df.limit(0), topk.F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_of_empty_vectors_and_repeated_ids(spark):
    rows = [(0, []), (1, []), (2, []), (20, [1.0, 2.0]), (20, [3.0, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (None, [5.0, 5.0]), (40, [9.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = sorted(map(tuple, topk.top_k(df, topk.F.col("vec_id") % 20 == 0, k=3).collect()))
    first, second = [(20, 1, 7, 3), (20, 2, 7, 3), (20, 3, 20, 3)], [(20, 1, 7, 3), (20, 2, 7, 3), (20, 3, 20, 3)]
    assert got == sorted([(0, 1, 1, 0), (0, 2, 2, 0), *first, *second])


@pytest.mark.parametrize("top", [10, 2**26, 2**31, 2**40, 1e300])
def test_scores_are_exact_at_any_size(spark, top):
    g = np.random.default_rng(7)
    v = np.floor(g.uniform(-1, 1, (60, 5)) * float(top))
    v[7] = v[9]
    whole = [[int(x) for x in row] for row in v.tolist()]
    got = topk.top_k(spark.createDataFrame([(i, row) for i, row in enumerate(v.tolist())], "vec_id long, v array<double>"), F.col("vec_id") % 20 == 0, 7, block_rows=25).collect()
    for q in (0, 20, 40):
        best = sorted((-sum(a * b for a, b in zip(whole[q], x, strict=True)), i) for i, x in enumerate(whole) if i != q)[:7]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert mine == [(k + 1, i, -s if -(2**63) <= -s < 2**63 else None) for k, (s, i) in enumerate(best)]


def test_limbs_keep_order_and_value(spark):
    edges = sorted({s * (1 << b) + d for b in (0, 30, 61, 62, 63, 64, 124, 130, 190) for s in (1, -1) for d in (-1, 0, 1)})
    for n in (2, 3, 4):
        some = [x for x in edges if abs(x) < 1 << (62 * n - 1)]
        cut = [topk.limbs(x, n) for x in some]
        assert cut == sorted(cut)
        got = spark.createDataFrame([(i, c) for i, c in enumerate(cut)], "i int, score array<long>").select("i", topk._as_long(n)).collect()
        assert {r[0]: r[1] for r in got} == {i: x if -(2**63) <= x < 2**63 else None for i, x in enumerate(some)}


def test_pivots_eliminate_candidates():
    """Of clustered vectors few are evaluated."""
    g = np.random.default_rng(5)
    centres = g.integers(-60, 60, (40, 16))
    v = (centres[g.integers(0, 40, 6000)] + g.integers(-2, 3, (6000, 16))).astype(float)
    far = topk.distances(v, topk.choose_pivots(v[:512], 16))
    rows = np.arange(6000)
    *_, evaluated = topk.best_of_block(rows[:50], v[:50], far[:50], rows, rows, v, far, 20)
    assert evaluated < 0.4 * 50 * 6000


@pytest.mark.parametrize(("copies", "best", "k"), [(1000, 10, 20), (1000, 30, 600), (6000, 10, 20)])
def test_top_k_evaluates_every_tied_bound_once(copies, best, k):
    g = np.random.default_rng(copies)
    n = 20_000
    v = g.integers(-3, 4, (n, 16)).astype(float)
    at = g.permutation(n)
    v[at[:copies]] = 6.0
    ids = g.permutation(n) * 3
    q = np.concatenate([np.full((2, 16), 6.0), g.integers(-9, 10, (4, 16))])
    v[at[copies : copies + best]] = g.integers(6, 9, (best, 16))
    pivots = topk.choose_pivots(v[:512], 16)
    a, b, s, evaluated = topk.best_of_block(-1 - np.arange(6), q, topk.distances(q, pivots), np.arange(n), ids, v, topk.distances(v, pivots), k)
    assert evaluated <= 6 * n
    for i in range(6):
        order = np.lexsort((ids, -(v @ q[i])))[:k]
        assert ids[b[i]].tolist() == ids[order].tolist() and s[i].tolist() == (v @ q[i])[order].tolist()


@pytest.mark.parametrize("compress", [False, True])
def test_warc_round_trip(spark, compress):
    pages = [(1, "u\r\n1", "same"), (2, "u2", "same"), (3, "u3", "é\r\n\r\nWARC/1.1\r\n"), (4, None, None), (5, "u5", ""), (None, "u6", "same"), (7, "u7", "z" * 3_000_000), *[(2, "u2", "same")] * 5, (2, "other", "same"), (2, "u2", "more")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    rows = warc.round_trip(df, compress=compress).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()  # noqa: E731, S324
    assert collections.Counter((r.page_id, r.payload_digest, r.payload_bytes) for r in rows) == collections.Counter((p[0], digest(p[2]), len((p[2] or "").encode())) for p in pages)
    kinds = collections.Counter((r.page_id, r.payload_digest == digest("same"), r.record_type, r.refers_to) for r in rows)
    assert kinds == {(1, True, "revisit", 2): 1, (2, True, "response", None): 1, (2, True, "revisit", 2): 6, (2, False, "response", None): 1, (3, False, "response", None): 1, (4, False, "revisit", 5): 1, (5, False, "response", None): 1, (None, True, "response", None): 1, (7, False, "response", None): 1}
    assert {r.page_id: bytes(r.payload) for r in rows}[3].decode() == pages[2][2]
    high = warc.round_trip(df, 5, compress).where("record_type = 'revisit'").count()
    assert high == 0 and warc.round_trip(df.limit(0), compress=compress).count() == 0


def test_packed_archives_may_be_one_member_and_damaged(tmp_path):
    import gzip

    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d:x>\r\nContent-Length: %d\r\n\r\n"
    data = b"".join(head % (i, 4000 * i) + b"p" * 4000 * i + b"\r\n\r\n" for i in range(1, 30))
    path = tmp_path / "one.warc.gz"
    path.write_bytes(gzip.compress(data))
    reader = warc.WarcReader({"path": str(path), "payload": "false"})
    assert list(reader.pushFilters([warc.In(("page_id",), (3, 29))])) == []
    assert [(r[0], r[4], r[7]) for r in reader.read(warc.WarcFile(str(path)))] == [(3, 12_000, None), (29, 116_000, None)]
    path.write_bytes(gzip.compress(data)[:-40])
    with pytest.raises(ValueError, match="breaks off"):
        list(reader.read(warc.WarcFile(str(path))))


def test_warc_pushdown_and_damage(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame([(i, "u", "t%d" % (i % 3)) for i in range(9)], "page_id long, url string, html string"), f"file://{path}")
    back = warc.read_archives(spark, f"file://{path}")
    assert back.where("record_type = 'revisit'").count() == 6 and back.where("page_id IN (2, 5)").count() == 2
    assert warc.read_archives(spark, f"file://{path}", payload=False).where("payload IS NOT NULL").count() == 0
    reader = warc.WarcReader({"path": path})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "response")])) == []
    assert sum(1 for p in reader.partitions() for _ in reader.read(p)) == 3
    bad = tmp_path / "bad.warc"
    bad.write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nshort")
    with pytest.raises(ValueError, match="breaks off"):
        list(reader.read(warc.WarcFile(str(bad))))


def held_out_accuracy(spark, name, column, sf="/root/testdata/sf0.1"):
    got = queries.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    h = [r for r in got if r.held_out]
    return [(r.predicted, r[column]) for r in h]


def test_toxicity(spark, edge, nothing):
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(20, 40)] + [(None, 1, 1), (1, None, None), (2, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(edge, labels).count() == edge.count()
    assert toxicity.score_toxicity(edge, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.without_toxic(edge, labels).columns == edge.columns and toxicity.score_toxicity(nothing, labels).count() == 0


def test_toxic_documents_are_found(spark):
    pairs = held_out_accuracy(spark, "op7_toxicity", "toxic")
    found, flagged = ([p for p, y in pairs if y == c] for c in (1, 0))
    assert sum(found) >= 0.9 * len(found) and sum(flagged) <= 0.02 * len(flagged)
    assert sum(found) >= 0.9 * (sum(found) + sum(flagged))


def test_a_few_toxic_words_in_a_long_text_are_found():
    g = random.Random(4)
    prose = lambda n: [g.choice(["river", "mill", "old", "quiet", "stone", "bridge", "lane", "garden"]) for _ in range(n)]
    bad, good = [[" ".join(prose(20) + [w] + prose(20)) for w in ("idiot", "moron")] * 20 for _ in range(1)][0], [" ".join(prose(41)) for _ in range(40)]
    s = toxicity.Scorer(*toxicity.train(bad + good, np.array([1] * 40 + [0] * 40)))
    long = prose(6000)
    assert s.scores([" ".join(long)])[0] < 0.5 < s.scores([" ".join(long[:3000] + ["idiot"] + long[3000:])])[0]


def test_training_rows_are_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, ("a" if i % 2 else "é") * 100 * i) for i in range(1, 41)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 41)], "doc_id long, toxic int")
    rows = toxicity.labelled_sample(docs, labels, "toxic", (50, 50), (9000, 5000))
    sizes = [sum(len(r.text.encode()) for r in rows if r.y == c) for c in (0, 1)]
    assert 0 < sizes[0] <= 9000 and 0 < sizes[1] <= 5000 and all(len(r.text) == 100 * r.labelled for r in rows)


def test_unseen_misspellings_share_ngrams():
    clean = ["the quiet river runs by the old mill"] * 6
    model = toxicity.train([c + " you idiot" for c in clean] + [c + " my friend" for c in clean], np.array([1] * 6 + [0] * 6))
    s = toxicity.Scorer(*model)
    bad, good = s.scores(["the quiet river runs idiott", "the quiet river runs friendd"])
    assert bad > good and s.scores([None, ""])[0] == s.scores([""])[0]


def test_quality(spark, edge, nothing):
    pairs = held_out_accuracy(spark, "op8_quality", "quality")
    assert sum(p == y for p, y in pairs) >= 0.97 * len(pairs)
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(20, 40)] + [(5, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.score_quality(edge, labels).count() == edge.count() and quality.score_quality(nothing, labels).count() == 0
    assert quality.score_quality(edge, labels.limit(0)).select("score").distinct().count() == 1


def test_no_measure_of_passages_is_dead(spark):
    x = np.concatenate([quality.passages(r.text) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").limit(3000).collect()])
    assert (x.std(0) > 0).all() and np.isfinite(x).all()
    assert np.allclose(x[:, : quality.N_CLASSES].sum(1), 1) and np.allclose((x[:, quality.MEASURES :] ** 2).sum(1), 1)
    assert (quality.passages(" \n") == 0).all() and quality.passages("a " * 300).shape == (3, quality.FEATURES)


def test_attention_against_plain_python():
    import math

    g = random.Random(9)
    rows = lambda n, m: [[g.uniform(-0.5, 0.5) for _ in range(m)] for _ in range(n)]
    f, h, k = quality.FEATURES, 3, 2
    p = {"mean": rows(1, f)[0], "scale": [1 + abs(x) for x in rows(1, f)[0]], "A": rows(f, h), "a": rows(1, h)[0], "V": rows(h, k), "U": rows(h, k), "w": rows(1, k)[0], "c": rows(1, h)[0], "b": [0.3]}
    times = lambda x, m: [sum(a * b for a, b in zip(x, c, strict=True)) for c in zip(*m, strict=True)]
    bags = [quality.passages(t) for t in ("one two three. " * 100, "", "A b\n" * 300)]
    for bag, score in zip(bags, quality.Attention({n: np.array(v) for n, v in p.items()}).scores(bags), strict=True):
        hidden = [[math.tanh(a + b) for a, b in zip(times([min(5, max(-5, (x - m) / s)) for x, m, s in zip(row, p["mean"], p["scale"], strict=True)], p["A"]), p["a"], strict=True)] for row in bag.tolist()]
        gate = [sum(w * math.tanh(t) / (1 + math.exp(-u)) for w, t, u in zip(p["w"], times(x, p["V"]), times(x, p["U"]), strict=True)) for x in hidden]
        total = sum(map(math.exp, gate))
        mixed = [sum(math.exp(e) / total * x[i] for e, x in zip(gate, hidden, strict=True)) for i in range(h)]
        assert abs(score - 1 / (1 + math.exp(-sum(a * b for a, b in zip(mixed, p["c"], strict=True)) - 0.3))) < 1e-12


def tokenizer(name):
    return Tokenizer.from_file(queries.tokenizer_file(name))


HARD = ["", " ", "  a  b", "a\n \n b ", "\n  x", " \t\n", "don't 'S I'LL", "x" * 5000, "é é İ ß ﬁ", "日本 語", "a b c", "<|endoftext|> a<|startoftext|>b", "1234 56,7.8--9", "\x1c a\x1d", "a\x85b", "😀 👍🏽 a​b", "  trailing  "]


def test_token_counts_equal_the_library(spark, edge, nothing):
    t, path = tokenizer("word_bpe_49k.json"), queries.tokenizer_file("word_bpe_49k.json")
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + HARD + [" ".join(HARD) * 40]
    want = [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    for c in (token_tables.ChunkCounter(path), token_tables.ChunkCounter(path, chunk=200, overlap=8), token_tables.ChunkCounter(path, chunk=30, overlap=1)):
        assert c.proves and c.counts(texts) == want
    for r in counts.count_tokens(edge, path).join(edge.select("doc_id", "text"), "doc_id").collect():
        n = len(t.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 2048, len((r.text or "").encode()))
    assert counts.count_tokens(nothing, path).count() == 0


def test_huge_texts_are_counted_from_their_chunks():
    path = queries.tokenizer_file("word_bpe_49k.json")
    c = token_tables.ChunkCounter(path, chunk=1000, overlap=100)
    text = "It's 12 naïve cafés, <|endoftext|> and more.\n" * 400
    want = len(c.tokenizer.encode(text, add_special_tokens=False).ids)
    assert c.counts([text]) == [want]
    assert c.calls >= len(text) / 1000 and len(text) < c.characters < 1.2 * len(text)  # every character is encoded, and few twice
    boundary, cuts = c.boundary, []
    c.boundary = lambda *a: cuts.append(boundary(*a)) or cuts[-1]
    c.counts([text])
    assert len(cuts) == len(set(cuts)) >= len(text) // 1000 and None not in cuts
    c.between = lambda chunk, a, b: token_tables.ChunkCounter.between(c, chunk, a, b + 7 if b < len(text) else b)  # splices at wrong places
    assert c.counts([text]) != [want]


@pytest.mark.parametrize("text", ["x" * 3000 + " a b c d", "é" * 2500, "a " + "日" * 900 + " b c d e f" * 200, ("y" * 700 + " ") * 9 + "k"])
def test_overlaps_are_widened(text):
    c = token_tables.ChunkCounter(queries.tokenizer_file("word_bpe_49k.json"), chunk=500, overlap=20)
    assert c.counts([text]) == [len(c.tokenizer.encode(text, add_special_tokens=False).ids)]
    assert len(text) <= c.characters < 2 * len(text)


@pytest.mark.parametrize("unit", ["Быстрая лиса прыгает через ленивую собаку, и ещё раз. ", "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。", "abcdefghij", "1234567890", "สวัสดีครับผมชื่อ", "l'été, don't 'sß「日本」ﾞ <|endoftext|>a|b<|end Σας ΣΑΣ  \u0301x "])
def test_long_texts_of_any_script_are_encoded_about_once(unit):
    for size in (40_000, 320_000):
        text = (unit * (size // len(unit) + 1))[:size]
        c = token_tables.ChunkCounter(queries.tokenizer_file("word_bpe_49k.json"))
        assert c.counts([text]) == [len(c.tokenizer.encode(text, add_special_tokens=False).ids)]
        assert c.characters < 1.1 * size


def test_random_mixtures_are_spliced_right():
    g = random.Random(6)
    units = ["l'été ", "don't we'll ", "「日本」", "ﾞ", "<|endoftext|>", "a|b<|end", "Σας ", " \u0301x", "12 3", "'S", "。a", "ᅡᄀ"]
    c = token_tables.ChunkCounter(queries.tokenizer_file("word_bpe_49k.json"), chunk=20, overlap=2)
    for _ in range(150):
        text = "".join(g.choice(units) if g.random() < 0.4 else g.choice("ab'. 1é日。ﾞᅡᄀ<|>\n") for _ in range(g.randint(50, 300)))
        assert c.counts([text]) == [len(c.tokenizer.encode(text, add_special_tokens=False).ids)]


def test_other_tokenizers_get_whole_texts(tmp_path):
    import json

    byte, word = (json.loads(tokenizer(n).to_str()) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    assert token_tables.cuts_at_spaces(byte) and token_tables.drops_white_space(word)
    assert not token_tables.cuts_at_spaces(word) and not token_tables.drops_white_space(byte)
    byte["pre_tokenizer"]["add_prefix_space"] = True
    word["added_tokens"][0]["lstrip"] = True
    for name, file in (("byte", byte), ("word", word)):
        (tmp_path / name).write_text(json.dumps(file))
    e, c = token_tables.ByteEncoder(str(tmp_path / "byte")), token_tables.ChunkCounter(str(tmp_path / "word"), chunk=10)
    assert not e.cuts and not c.proves
    ids, at = e.encode(pa.array(HARD), 7)
    assert [ids[i:j].tolist() for i, j in zip(at, at[1:], strict=False)] == [[*e.tokenizer.encode(x, add_special_tokens=False).ids, 7] for x in HARD]
    assert c.counts(HARD) == [len(c.tokenizer.encode(x, add_special_tokens=False).ids) for x in HARD]


def test_ids_equal_the_library(spark):
    t, path = tokenizer("byte_bpe_50k.json"), queries.tokenizer_file("byte_bpe_50k.json")
    g = random.Random(1)
    bits = ["a", "s", "t", "re", "ll", "'", " ", "  ", "\n", "\t", "1", ".", "é", "×", "ß", "ɐ", "Ɉ", "²", "\xa0", "“", "日", "<|endoftext|>", "\x1c", "\u3000", "d", "ve", "😀"]
    mixed = ["".join(g.choice(bits[: g.choice((12, 27))]) for _ in range(g.randint(0, 14))) for _ in range(8000)]
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + HARD + [a + b for a in HARD for b in HARD] + mixed + [None]
    want = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    for e, rows in ((token_tables.ByteEncoder(path), 3000), (token_tables.ByteEncoder(path, most_bytes=30_000, gather=50), 200)):
        for end in (None, 0):
            for at in range(0, len(texts), rows):
                ids, b = e.encode(pa.array(texts[at : at + rows], pa.string()).slice(1), end)
                got = [ids[i:j].tolist() for i, j in zip(b, b[1:], strict=False)]
                assert got == [w + [0] * (end == 0) for w in want[at + 1 : at + rows]]


def test_token_files_round_trip(edge, nothing):
    t, path = tokenizer("byte_bpe_50k.json"), queries.tokenizer_file("byte_bpe_50k.json")
    rows = token_files.token_round_trip(edge, path, with_ids=True).collect()
    src = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()) for r in edge.collect()))  # equal doc_ids have equal texts
    at = 0
    for r, (known, i, _, text) in zip(sorted(rows, key=lambda r: r.start), src, strict=True):
        ids = [*t.encode(text.decode(), add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i if known else None, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_files.token_round_trip(nothing, path).count() == 0


def test_one_doc_id_may_fill_many_token_files(spark, tmp_path):
    rows = [(7 if i % 3 else i if i % 2 else None, f"text {i} " * 3) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path, folder = queries.tokenizer_file("byte_bpe_50k.json"), f"file://{tmp_path}/t"
    parts = token_files.write_token_files(df, folder, path)
    sizes = [r.n_docs for r in parts.collect()]
    assert sum(sizes) == 900 and len(sizes) >= 3 and max(sizes) < 400
    back = token_files.read_token_files(parts, folder, with_ids=True).collect()
    t = tokenizer("byte_bpe_50k.json")
    want = collections.Counter((i, *t.encode(x, add_special_tokens=False).ids, 0) for i, x in rows)
    assert collections.Counter((r.doc_id, *r.ids) for r in back) == want
    ids = [r.doc_id for r in sorted(back, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_pipeline_writes_tokens_in_training_order(spark, tmp_path):
    import corpus_pipeline

    out = corpus_pipeline.mix_sources(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    trained_on = [r.doc_id for r in out.collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    out.write.parquet(str(tmp_path / "mixing"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = corpus_pipeline.write_tokens(spark, spark.read.parquet(str(tmp_path / "mixing")), SF).collect()
    assert len(list((tmp_path / "mixing").glob("part-*"))) > 1
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == trained_on != sorted(trained_on)


def test_pipeline(spark, tmp_path):
    """Each stage against its plain version, on all that the one before kept."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "token_files":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert {tuple(r) for r in docs.collect()} <= {tuple(r) for r in before}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            bad = {r[0] for r in brute_contamination([(r.doc_id, r.text) for r in before], items) if r[-1]}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before} - bad
        if name == "near_duplicates":
            assert docs.select("text").distinct().count() == docs.count()
    assert docs.count() == len(before)
    assert corpus_pipeline.run(spark, SF).agg({"n_tokens": "sum"}).first()[0] == docs.agg({"n_tokens": "sum"}).first()[0]
