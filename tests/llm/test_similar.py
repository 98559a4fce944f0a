"""Similarity joins and searches against brute force and odd inputs."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import corpus
from tokenmill.llm import decontam, idfilter, neardup_vectors, ngram_join, queries
from tokenmill.llm.common import shingle_sets
from tokenmill.llm.components import components

SF = "/root/testdata/sf0.001"
queries.load_all()


def check_links(got, ids, texts):
    sets = [corpus.shingles(t) for t in texts]
    roots = corpus.linked(sets)
    least = {}
    for i, r in zip(ids, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = collections.Counter((i, len(s), least.get(r) if s else i) for i, s, r in zip(ids, sets, roots, strict=True))
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want


def test_join_links_what_brute_force_links(spark):
    texts = corpus.odd_texts()
    ids = [None, *range(1, len(texts))]
    got = ngram_join.link_documents(corpus.frame(spark, texts, ids=ids))
    check_links(got.collect(), ids, texts)


def test_join_query_on_given_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op2_ngram_jaccard_join"](spark, SF).collect()
    check_links(got, [r["doc_id"] for r in rows], [r["text"] for r in rows])


def test_join_of_empty_and_blank_tables(spark):
    assert ngram_join.link_documents(corpus.frame(spark, [])).count() == 0
    got = ngram_join.link_documents(corpus.frame(spark, [None, "", " "])).collect()
    assert [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in sorted(got)] == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]


def test_sketches_bound_the_difference_from_below():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x, y = (rng.choice(1 << 12, int(rng.integers(1, 900)), replace=False).astype(np.uint64) << np.uint64(18) for _ in range(2))
        x, y = np.unique(x), np.unique(y)
        d = ngram_join.sketch_distance(ngram_join.sketch(x), ngram_join.sketch(y))
        assert d <= len(np.setxor1d(x, y)) and ngram_join.sketch_distance(ngram_join.sketch(x), ngram_join.sketch(x)) == 0


def _pairs_with_similarity(rng, n):
    """A random set and one that differs in about the largest number of members allowed."""
    x = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
    h = int(ngram_join.needed(np.array([n]), ngram_join.band(np.array([n])) + 1, 75)[0]) - 1
    drop = int(rng.integers(0, h + 1))
    y = np.concatenate([x[drop:], rng.choice(1 << 40, int(rng.integers(0, h - drop + 1)), replace=False).astype(np.uint64)])
    return np.unique(x), np.unique(y)


def test_linked_sets_agree_in_a_segment_unless_both_are_short():
    """The pigeonhole: some segment that is not empty has the same members."""
    rng = np.random.default_rng(9)
    for _ in range(400):
        x, y = _pairs_with_similarity(rng, int(rng.integers(4, 400)))
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        sizes = np.array([len(x), len(y)])
        sigs = [collections.defaultdict(set) for _ in sizes]
        short = [set(), set()]
        for role, members, bands in ngram_join.roles(sizes, 75):
            if not len(members):
                continue
            owner, seg, count, total, _, _ = ngram_join.parts([(x, y)[i] for i in members], bands)
            sig = ngram_join.signature(bands[owner], seg, count, total)
            for o, s in zip(owner, sig, strict=True):
                sigs[members[o]][int(bands[o])].add(int(s))
            for m, b, n in zip(members, bands, np.bincount(owner, minlength=len(members)), strict=True):
                if n < ngram_join.needed(sizes[m:m + 1], np.array([b]), 75)[0]:
                    short[m].add(int(b))
        met = max(int(b) for b in ngram_join.band(sizes))
        assert sigs[0][met] & sigs[1][met] or (met in short[0] and met in short[1])


def test_short_sets_are_found_by_deletions_and_blocks(spark):
    """The last steps on their own: every class counts as short."""
    texts = corpus.odd_texts()[8:60]
    docs = corpus.frame(spark, texts).select("doc_id", "text", F.xxhash64("text").alias("ref"))
    sets = shingle_sets(texts)
    sids = [ngram_join.class_id(s, 0)[0] for s in sets]
    classes = spark.createDataFrame([(i, r["ref"], len(s), bytearray(ngram_join.sketch(s))) for i, s, r in zip(
        sids, sets, docs.orderBy("doc_id").collect(), strict=True)], "sid long, ref long, n long, sketch binary").dropDuplicates(["sid"])
    names = list(dict.fromkeys(sids))
    want = {r: s for r, s in zip(names, corpus.linked([frozenset(sets[sids.index(n)].tolist()) for n in names]), strict=True)}

    def partition(join):
        roots = {r["node"]: r["root"] for r in join.roots.collect()}
        groups = collections.defaultdict(set)
        for n in names:
            groups[roots.get(n, n)].add(n)
        return sorted(map(sorted, groups.values()))

    truth = collections.defaultdict(set)
    for n, r in want.items():
        truth[r].add(n)
    truth = sorted(map(sorted, truth.values()))
    join = ngram_join.Join(docs, classes, 0, 75, 5)
    join.add(spark.createDataFrame([], "a long, b long"))
    ngram_join.compare_blocks(join, spark.createDataFrame([(n, 1) for n in names], "sid long, band int"))
    assert partition(join) == truth
    join = ngram_join.Join(docs, classes, 0, 75, 5)
    join.add(spark.createDataFrame([], "a long, b long"))
    lost = spark.createDataFrame([(n, role, 10**6) for n in names for role in (0, 1)], "sid long, role int, lost long")
    still = ngram_join.deletion_round(join, lost)
    ngram_join.compare_blocks(join, still)
    assert partition(join) == truth


@pytest.mark.parametrize("template,own,n", [(13, 3, 400), (25, 7, 300)])
def test_extensions_of_one_template_all_link(spark, template, own, n):
    """Each text links with the template only, at the threshold; the group is larger than any list."""
    base = " ".join(f"t{i}" for i in range(template))
    texts = [base] + [f"{base} " + " ".join(f"own{i}x{j}" for j in range(own)) for i in range(n)]
    sets = [corpus.shingles(t) for t in texts]
    assert all(100 * len(sets[0] & s) >= 75 * len(sets[0] | s) for s in sets)
    assert 100 * len(sets[1] & sets[2]) < 75 * len(sets[1] | sets[2])
    # the template's id is the largest: it is no pivot by its id
    ids = [n, *range(n)]
    check_links(ngram_join.link_documents(corpus.frame(spark, texts, ids=ids)).collect(), ids, texts)


def test_one_document_of_each_group_stays(spark):
    texts = corpus.odd_texts()
    ids = [None, *range(1, len(texts))]
    d = corpus.frame(spark, texts, ids=ids)
    kept = ngram_join.one_per_component(d)
    assert kept.columns == d.columns
    linked = ngram_join.link_documents(d).where("doc_id is null or doc_id = component_id")
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(r["doc_id"] or 0 for r in linked.collect())


def test_components_against_union_find(spark):
    rng = random.Random(4)
    for n, m in ((1, 0), (60, 50), (200, 400)):
        edges = [(rng.randrange(n) * 2654435761 % 10007, rng.randrange(n) * 2654435761 % 10007) for _ in range(m)]
        edges += [(i * 2654435761 % 10007, (i + 1) * 2654435761 % 10007) for i in range(n, n + 40)]  # a chain
        rows = components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect()
        root = {r["node"]: r["root"] for r in rows}
        assert all(root[a] == root[b] for a, b in edges if a != b)
        groups = collections.defaultdict(set)
        for a, r in root.items():
            groups[r].add(a)
        near = collections.defaultdict(set)
        for a, b in edges:
            near[a].add(b)
            near[b].add(a)
        for g in groups.values():  # every group is reachable from one of its nodes
            seen, todo = set(), [next(iter(g))]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += near[x]
            assert g <= seen


def test_filter_never_loses_a_key(spark):
    d = spark.range(3000).select((F.col("id") * 7 - 900).alias("k"), F.lit("x").alias("t")).union(
        spark.createDataFrame([(None, "n")], "k long, t string"))
    keys = d.where("k % 3 = 0").select("k")
    want = {r["k"] for r in keys.collect()}
    assert want <= {r["k"] for r in idfilter.matching(d, "k", keys).collect()}
    left = [r["k"] for r in idfilter.without(d, "k", keys).collect()]
    assert len(left) == 3001 - len(want) and not want & set(left) and None in left


def contained_model(texts, items):
    inv = collections.defaultdict(list)
    for i, t in items:
        for x in corpus.shingles(t):
            inv[x].append(i)
    size = {i: len(corpus.shingles(t)) for i, t in items}
    out = set()
    for d, t in enumerate(texts):
        n = collections.Counter(i for x in corpus.shingles(t) if x in inv for i in inv[x])
        out |= {(d, i, size[i], k) for i, k in n.items() if 100 * k >= 75 * size[i]}
    return out


def test_contained_items_are_found_in_long_documents(spark):
    rng = random.Random(6)
    items = [(i, " ".join(corpus.words(rng, n, 10**6))) for i, n in enumerate([3, 5, 6, 9, 14, 30, 59, 64, 65, 200] * 4)]
    texts = corpus.odd_texts()
    for i, t in items:
        w = t.split()
        for keep in (1.0, 0.9, 0.8):  # whole, and with the end cut off
            part = w[: max(1, math.ceil(len(w) * keep))]
            texts.append(" ".join(corpus.words(rng, rng.randrange(0, 8000)) + part + corpus.words(rng, rng.randrange(0, 3000))))
        texts.append(t.upper())
    odd = [(100, None), (101, ""), (102, "  ")]
    table = spark.createDataFrame(items + odd, "item_id long, text string").withColumn("n_item", F.lit("clash"))
    got = decontam.find_contained(corpus.frame(spark, texts), table)
    want = contained_model(texts, items)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 100
    clean = decontam.decontaminate(corpus.frame(spark, texts), table)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, *_ in want}
    assert clean.columns == corpus.frame(spark, []).columns


def test_containment_of_empty_tables(spark):
    d = corpus.frame(spark, ["a b c d e f", None])
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.find_contained(d, none).count() == 0 == decontam.find_contained(d.limit(0), one).count()
    assert decontam.decontaminate(d, none).count() == 2 and decontam.decontaminate(d, one).count() == 1


def test_containment_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = queries.QUERIES["op6_decontamination"](spark, sf).collect()
    want = contained_model([r["text"] for r in docs], items)
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(docs[d]["doc_id"], i) for d, i, _, _ in want} and want


def vector_model(vectors, cosine=0.95):
    good = [i for i, v in enumerate(vectors) if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i in range(len(vectors))}
    for n, i in enumerate(good):
        for j in good[:n]:
            if len(vectors[i]) == len(vectors[j]):
                a, b = (np.asarray(vectors[x], float) / np.abs(vectors[x]).max() for x in (i, j))
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    return links


def test_vectors_link_like_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 16))
    vectors = [(b + s * rng.standard_normal(16)).tolist() for b in base for s in (0.01, 0.03, 0.05, 0.3)]
    hot = rng.standard_normal(16)  # a bucket larger than one block
    vectors += [(hot + 0.02 * rng.standard_normal(16)).tolist() for _ in range(700)]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[5]], None, [], [0.0] * 16, [float("nan")] * 16,
                [None] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e300] * 16, [1e300] * 16]
    ids = list(range(len(vectors)))
    d = spark.createDataFrame([(i, v, 1, "x") for i, v in zip(ids, vectors, strict=True)],
                              "vec_id long, embedding array<double>, links int, key string")
    got = {r["vec_id"]: r for r in neardup_vectors.link_vectors(d).collect()}
    links = vector_model(vectors)
    true = sum(map(len, links.values()))
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= len(links[i]) for i in ids) and found >= 0.98 * true
    for i in ids:
        r = got[i]
        assert r["kept"] == (r["vec_id"] == r["component_id"])
        if not links[i]:
            assert (r["n_links"], r["component_id"]) == (0, i)
    assert len({got[i]["component_id"] for i in range(160, 860)}) == 1
    assert neardup_vectors.link_vectors(d.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, [1.0, 0.0]), (3, [1.0, 0.0]), (None, None)], "vec_id long, embedding array<double>")
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in neardup_vectors.link_vectors(
        nulls).collect()) == [(0, 0, 0, False), (0, 1, 3, False), (3, 1, 3, True)]


def test_vector_recall_on_given_embeddings(spark):
    """All vectors of a given table and planted groups at cosines on both sides of the threshold."""
    given = np.array([r["embedding"] for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy(
        "vec_id").collect()], float)
    rng = np.random.default_rng(31)
    group = np.repeat(given[:80], 8, axis=0)
    far = rng.uniform(0.0, 0.4, (len(group), 1)) * np.linalg.norm(group, axis=1, keepdims=True)
    noise = rng.standard_normal(group.shape)
    x = np.concatenate([given, group + far * noise / np.linalg.norm(noise, axis=1, keepdims=True)])
    d = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in neardup_vectors.link_vectors(d).collect()}
    have = np.array([got[i] for i in range(len(x))])
    assert (have <= want).all() and have.sum() >= 0.98 * want.sum() > 1000


@pytest.mark.parametrize("n", [2, 10**4, 10**9])
def test_table_plan_keeps_recall_at_the_threshold(n):
    k, tables = neardup_vectors.table_plan(n)
    p = neardup_vectors.collision(math.sqrt(0.1))
    assert 1 - (1 - p ** k) ** tables >= 0.99


def test_pairs_that_only_meet_beside_a_pivot(spark):
    """Sets that link with each other but not with the pivot of their lists, and
    texts that share a passage with many others and link with a few of them."""
    rng = random.Random(12)
    texts = []
    for _ in range(30):
        base = corpus.words(rng, 100)
        texts.append(" ".join(base[:60] + corpus.words(rng, 20)))  # shares segments with the next two
        texts += [" ".join(base + corpus.words(rng, 6)) for _ in range(2)]
    passage = corpus.words(rng, 40)
    for _ in range(60):
        own = corpus.words(rng, 30)
        texts += [" ".join(own + passage), " ".join(passage + own[:rng.randrange(20, 30)])]
    rng.shuffle(texts)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link_documents(corpus.frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == corpus.linked([corpus.shingles(t) for t in texts])


def test_items_of_equal_sets_are_searched_once(spark, monkeypatch):
    """A third of the items are one text; many small blocks give the same rows as one."""
    rng = random.Random(40)
    passages = [" ".join(corpus.words(rng, 20)) for _ in range(40)]
    items = [(i, passages[0] if i % 3 == 0 else passages[i % 40]) for i in range(300)] + [(None, passages[0]), (301, None), (302, "")]
    texts = [" ".join([*corpus.words(rng, 200), p, *corpus.words(rng, 50)]) for p in passages[:12]] + corpus.odd_texts()
    want = sorted(((d, i if i is not None else -1) for d, i, _, _ in contained_model(texts, items)))
    frame = spark.createDataFrame(items, "item_id int, text string")
    sets = decontam.item_sets(frame, "item_id", "text", 5)
    assert sum(len(b.ids) for b in decontam.item_blocks(sets)) == sets.select("set_key").distinct().count() <= 40
    for size in (decontam.BLOCK_BYTES, 1000):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", size)
        got = decontam.find_contained(corpus.frame(spark, texts), frame).collect()
        assert sorted((r["doc_id"], r["item_id"] if r["item_id"] is not None else -1) for r in got) == want
    assert {d for d, _ in want} >= set(range(12))
    kept = decontam.decontaminate(corpus.frame(spark, texts), frame)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_sets_with_spare_segments_take_no_part_in_star_rounds(spark):
    stars = spark.createDataFrame([(1, 10, 10, 0), (1, 10, 11, 0), (1, 10, 12, 0), (2, 10, 10, 0), (2, 10, 11, 0), (1, 11, 11, 0)],
                                  "sig long, pivot long, member long, role int")
    slack = spark.createDataFrame([(10, 0, 5), (11, 0, 1), (12, 0, 0), (12, 1, 9), (13, 0, -1)], "sid long, role int, slack int")
    got = ngram_join.short_members(stars, slack).collect()
    assert sorted((r["sig"], r["member"], r["role"]) for r in got) == [(1, 11, 0), (1, 12, 0), (2, 11, 0)]
