"""Operators over the whole corpus beside brute force: dedup, neighbours, mixing, the pipeline."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from parcelpulse.llm import common, graph, minhash_dedup, mixture_cube, projected_neighbours, suffix_dedup
from parcelpulse.llm.common import shingle_set, table
from parcelpulse.session import new_folder


def near_components(rows):
    """component_id of each row, by comparing all sets."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return [(d, len(s), d if not s else least.get(find(k))) for k, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def in_order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_near_duplicates_equal_brute_force(name, request, rows_of):
    source = request.getfixturevalue(name)
    result = minhash_dedup.near_duplicates(source)
    wanted = near_components(rows_of(source, "doc_id", "text"))
    assert in_order(rows_of(result, "doc_id", "n_shingles", "component_id")) == in_order(wanted)
    assert all(k == (d == c) for d, c, k in rows_of(result, "doc_id", "component_id", "kept"))


def test_chains_of_copies_in_one_bucket(spark, monkeypatch):
    """Neighbours in the chain are similar, its ends are not; buckets come in chunks."""
    monkeypatch.setattr(minhash_dedup, "CHUNK", 8)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[6 * k : 6 * k + 100])) for k in range(40)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash_dedup.near_duplicates(made).collect()
    wanted = {d: c for d, _, c in near_components(rows)}
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted


def test_one_of_each_component_stays(odd, docs):
    kept = minhash_dedup.one_of_each(docs)
    wanted = minhash_dedup.near_duplicates(docs).where("kept")
    assert in_order(r["doc_id"] for r in kept.collect()) == in_order(r["doc_id"] for r in wanted.collect())
    assert kept.columns == docs.columns
    assert len([r for r in minhash_dedup.one_of_each(odd).collect() if r["text"] == "one two three"]) == 1


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100 + k, 100) for k in range(1, 50)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {k: 0 for k in range(61)} | {100 + k: 100 for k in range(50)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats(rows, length=100):
    """By sets of byte strings, in order of id; rows of equal id and text are one document."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            string = data[p : p + length]
            if string in seen:
                gone[p : p + length] = True
            seen.add(string)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[doc_id, text] = (doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return in_order(out[r] for r in rows)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_removed_repeats_equal_brute_force(spark, docs, empty, rows_of):
    assert in_order(rows_of(suffix_dedup.remove_repeats(docs), *COLUMNS)) == repeats(rows_of(docs, "doc_id", "text"))
    assert suffix_dedup.remove_repeats(empty).count() == 0
    line = "".join(map(chr, range(48, 110)))
    rows = [(1, line * 3), (2, "x" + line * 2), (3, "é" * 80), (4, "aé" + "é" * 79), (5, "ab" * 300), (6, "ab" * 70)]
    rows += [(7, None), (8, ""), (9, line[:50] + line * 2), (9, line[:50] + line * 2), (None, line * 2), (12, "c" * 99)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    assert in_order(rows_of(suffix_dedup.remove_repeats(made), *COLUMNS)) == repeats(rows)


def test_texts_longer_than_a_chunk(spark, monkeypatch, rows_of):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 512)
    noise = "".join(map(chr, np.random.default_rng(5).integers(97, 123, 3000)))
    rows = [(1, noise), (2, "x" * 7 + noise[200:2500] + "y"), (3, noise[2400:] + noise[:300])]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    assert in_order(rows_of(suffix_dedup.remove_repeats(made), *COLUMNS)) == repeats(rows)


def amid_noise(phrases, n):
    random = np.random.default_rng(11)
    return [(k, random.bytes(75).hex() + phrases[k % len(phrases)] + random.bytes(75).hex()) for k in range(n)]


def test_phrase_in_many_documents(spark, monkeypatch, rows_of):
    monkeypatch.setattr(suffix_dedup, "TOKEN_RUNS", 5)
    line = "".join(map(chr, range(35, 125)))
    rows = amid_noise([line, line + line[:40], line[:30]], 120) + [(200, line * 3), (201, line * 2), (None, line * 2)]
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert in_order(rows_of(suffix_dedup.remove_repeats(made), *COLUMNS)) == repeats(rows)


def test_a_common_phrase_is_no_group_of_one_task(spark):
    """Unlike runs under one token, as many as there are documents."""
    rows = amid_noise(["".join(map(chr, range(35, 95)))], 3 * suffix_dedup.TOKEN_RUNS // 2)
    texts = spark.createDataFrame([(k, 0, t) for k, t in rows], "id long, tie long, text string")
    shared = texts.selectExpr("7L as token", "id", "tie", "(131L << 14) | 60 as place")
    strings = suffix_dedup.unlike_strings(shared, texts, 100)
    counts = strings.groupBy("token").count().toPandas()["count"]
    assert counts.max() <= suffix_dedup.TOKEN_RUNS
    assert counts.sum() == 61 * len(rows)


def test_a_token_of_several_splitters_has_several_buckets():
    splitters = np.array([-5, 3, 3, 3, 9])
    tokens = np.array([-6, 3, 3, 3, 3, 4, 9, 10]) << 12
    buckets = suffix_dedup.buckets_of(tokens, np.array([7, 0, 1, -1, 3, 5, 5, 5]), splitters)
    assert buckets.tolist() == [0, 1, 2, 3, 1, 4, 4, 5]


def test_multikey_order():
    tokens = np.random.default_rng(3).integers(0, 3, (500, 4)).astype(np.uint64)
    order, run = suffix_dedup.multikey_order(tokens)
    assert tokens[order].tolist() == sorted(tokens.tolist())
    same = [a == b for a, b in zip(tokens[order][1:].tolist(), tokens[order][:-1].tolist(), strict=True)]
    assert (run[1:] == run[:-1]).tolist() == same


def test_neighbours_recall(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    found = {}
    for r in projected_neighbours.nearest(rows).collect():
        found.setdefault(r["query_id"], []).append(r)
    data = rows.orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in data])
    vectors = np.array([r["embedding"] for r in data], float)
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        products = vectors @ vectors[at]
        products[at] = -np.inf
        near = set(ids[np.lexsort((ids, -products))[:20]].tolist())
        mine = sorted(found[ids[at]], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(a["score"] >= b["score"] for a, b in zip(mine, mine[1:], strict=False))
        hits += len(near & {r["vec_id"] for r in mine})
        total += 20
    assert hits >= 0.9 * total


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0])]
    rows += [(7, [1.0, inf]), (8, [None, 1.0]), (9, [-1.0, 3.0]), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [0.0, 1.0])]
    rows += [(30 + k, [2.0, 0.0]) for k in range(30) if k % 10]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = [tuple(r) for r in projected_neighbours.nearest(made).orderBy("query_id", "rank").collect()]
    of_0 = [v for q, _, v, _ in found if q == 0]
    assert of_0 == [1, 2] + [30 + k for k in range(30) if k % 10][:18]
    assert [v for q, _, v, _ in found if q == 20][0] == 9
    assert {q for q, *_ in found} == {0, 20}
    assert projected_neighbours.nearest(made.where("false")).count() == 0


def test_neighbours_of_repeated_rows(spark):
    rows = [(0, [2.0, 0.0])] * 25 + [(k, [2.0, 0.0]) for k in (1, 2, 4, 5)] + [(3, [2.0, 0.0])] * 30
    rows += [(k, [3.0, 0.1]) for k in (41, 42)] + [(60 + k, [1.0, 0.01 * k]) for k in range(1, 19)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = projected_neighbours.nearest(made).where("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [41, 42, 1, 2] + [3] * 16
    made = made.where("vec_id <> 3")
    found = projected_neighbours.nearest(made).where("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in found][:6] == [41, 42, 1, 2, 4, 5]


def test_rows_of_one_query_id_with_different_vectors(spark):
    """The smallest vector asks, however the rows lie; all its other rows are left out."""
    rows = [(20, [0.0, 1.0]), (20, [1.0, 0.0]), (20, [0.5, 5.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0]), (3, [1.0, 1.0, 1.0])]
    answers = set()
    for parts in (1, 3, 6):
        made = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        made = made.selectExpr("*", "7 AS dims", "'x' AS shard").repartition(parts)
        answers.add(tuple(tuple(r) for r in projected_neighbours.nearest(made).orderBy("rank").collect()))
    assert answers == {((20, 1, 2, 1.0), (20, 2, 1, 0.1))}


def test_ties_go_to_the_smaller_id():
    """More equal products than a search keeps otherwise, in one leaf and over leaves."""
    ids = np.random.default_rng(2).permutation(1_000)
    vectors = np.tile([0.3, 0.7, 0.1], (1_000, 1))
    found = projected_neighbours.search(ids, vectors, np.array([5]), vectors[:1], 0.59, 20, 0.05)
    assert found["vec_id"].tolist() == [k for k in range(21) if k != 5]


def water(sizes, weights=(5.0, 2.0, 1.0)):
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        all_ = sum(weight[s] for s in names if s not in full)
        out = {s: 3 * sizes[s] if s in full else rest * weight[s] / all_ for s in names}
        more = {s for s in names if out[s] > 3 * sizes[s] + 1e-9}
        if not more:
            return out
        full |= more


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_mix_meets_targets(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    units = mixture_cube.copies(docs).collect()
    sizes, taken = {}, {}
    for r in units:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"] * r["n_rows"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["n_rows"] * r["taken_copies"]
        assert 0 <= r["taken_copies"] <= 3
    target = water(sizes)
    for r in units:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
    slack = 0.001 if sf == "sf0.1" else 0.1  # a source of ten documents is coarse
    assert all(abs(taken[s] - target[s]) <= 20 + slack * target[s] for s in sizes)
    assert in_order(map(tuple, mixture_cube.mix(docs).collect())) == in_order(map(tuple, mixture_cube.mix(docs.repartition(7)).collect()))


def test_mix_of_odd_rows(odd, empty):
    assert mixture_cube.mix(odd).count() == odd.count()
    assert mixture_cube.mix(empty).count() == 0
    assert mixture_cube.take(odd).columns == odd.columns


def test_blocks_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixture_cube, "BLOCK", 50)
    rows = [(k, "w " * (1 + k % 37), "ab"[k % 5 == 0]) for k in range(3000)]
    result = mixture_cube.copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(result) == 3000
    for source in "ab":
        mine = [r for r in result if r["source"] == source]
        assert abs(sum(r["size"] * r["taken_copies"] for r in mine) - mine[0]["target"]) <= 20


def test_flight_keeps_sums():
    rng = np.random.default_rng(0)
    sizes, probs = rng.integers(1, 500, 400).astype(float), rng.random(400)
    out = mixture_cube.flight(sizes, probs, rng)
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert out.sum() == pytest.approx(probs.sum())
    assert (out * sizes).sum() == pytest.approx((probs * sizes).sum())


def test_pipeline_stages(spark, docs):
    sf_dir = "/root/testdata/sf0.001"
    now, path = docs, public_tokenizers.path("byte_bpe_50k.json")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, corpus_pipeline.stash(stage(spark, now, sf_dir), "stage")
        assert now.columns == docs.columns, name
        assert now.dtypes == docs.dtypes
        ids = {r["doc_id"] for r in before.collect()}
        assert {r["doc_id"] for r in now.collect()} <= ids
        if name == "minhash near-dedup":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert sorted(r["doc_id"] for r in now.collect()) == sorted(d for d, _, c in near_components(rows) if d == c)
    tokenizer = Tokenizer.from_file(path)
    wanted = []
    for r in now.collect():
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [2]
        wanted.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    result = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in result) == sorted(wanted)


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty):
    """Nulls, repeated and equal ids, long texts, clashing columns; no rows, no labels, no test items."""
    labels = odd.where("doc_id is not null").selectExpr("doc_id", "1 AS quality", "cast(doc_id % 2 AS int) AS toxic", "text AS label")
    items = spark.createDataFrame([(1, None, 1), (2, "one two three four five", 2)], "item_id long, text string, segment int")
    clashing = odd.selectExpr("*", "1 AS label", "'p' AS part", "2 AS whole", "'k' AS key", "text AS tie")
    for documents, known, tests in ((clashing, labels, items), (empty, labels, items), (odd, labels.where("false"), items.where("false"))):
        folder = new_folder(spark, "tables")
        for name, rows in (("documents", documents), ("labels", known), ("benchmark", tests)):
            rows.write.parquet(f"{folder}/{name}.parquet")
        now = table(spark, folder, "documents")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = corpus_pipeline.stash(stage(spark, now, folder), "stage")
            assert now.columns == documents.columns, name
        ids = [r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()]
        assert len(ids) == now.count()
        assert set(ids) <= {r["doc_id"] for r in documents.select("doc_id").collect()}


def test_a_worker_forgets_what_another_step_has_kept(spark):
    """Spark uses its Python workers again: the encoder's words would lie beside the next step's data."""
    from parcelpulse.llm.common import map_arrow, process_store

    def keep(batches):
        process_store()["encoder"] = "words"
        yield from batches

    def kept(batch):
        yield pa.record_batch({"n": [sum(not k.startswith("__") for k in process_store())]})

    rows = spark.range(8).repartition(1)
    assert rows.mapInArrow(keep, "id long").count() == 8
    assert {r.n for r in map_arrow(rows, kept, "n long").collect()} == {0}


def test_rounds_of_components_write_as_many_files_as_their_edges_need(spark, monkeypatch):
    seen = []

    def stash(df, name):
        held = common.stash(df, name)
        seen.append(len(held.inputFiles()))
        return held

    monkeypatch.setattr(graph, "stash", stash)
    monkeypatch.setattr(graph, "EDGES_PER_FILE", 20, raising=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        edges = spark.createDataFrame([(k, k + 1) for k in range(100) if k % 10], "a long, b long")
        found = graph.components(edges).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.node, r.component) for r in found} == {(k, (k - 1) // 10 * 10 + 1) for k in range(1, 101)}
    assert max(seen[1:]) <= 8
