import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tickflow.llm import jaccard_join
from tickflow.llm.common import package_on_workers
from tickflow.llm.components import components
from tickflow.llm.forest_search import forest_search
from tickflow.llm.jaccard_join import Bands, jaccard_components, one_of_each, shingle_set, signatures
from tickflow.llm.sharding import balanced_shards


@pytest.fixture(scope="module")
def near_rows():
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(200)]
    rows = []
    for _ in range(25):
        base = [random.choice(vocabulary) for _ in range(random.choice([2, 4, 7, 9, 12, 20, 40, 90, 250]))]
        for _ in range(random.randint(2, 8)):
            w = list(base)
            for _ in range(random.randint(0, 1 + len(w) // 25)):
                i = random.randrange(len(w))
                w[i:i + 1] = random.choice([[random.choice(vocabulary)], [w[i], "x"], []]) or [w[i]]
            rows.append((len(rows) * 3 + 5, " ".join(w)))
    rows += [(r[0] + 1, r[1]) for r in rows[:6]]
    return rows + [(None, "a b c d e f g"), (9001, "a b c d e f g"), (9002, None), (9003, " \n"), (9004, "A B c"),
                   (9005, "a b C"), (9005, "a b C"), (9006, rows[0][1]), (9006, "zz yy")]


def test_components_over_chains_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_sets_share_a_signature():
    random.seed(2)
    for percent in (80, 85):
        bands = Bands(percent)
        for size in [6, 7, 9, 12, 17, 30, 60, 150, 400]:
            for _ in range(60):
                a = {random.getrandbits(64) for _ in range(size)}
                b = set(a)
                for _ in range(size):  # as different as the similarity allows
                    c = set(b)
                    c.discard(random.choice(sorted(c)))
                    if random.random() < 0.5:
                        c.add(random.getrandbits(64))
                    if 100 * len(a & c) < percent * len(a | c):
                        break
                    b = c
                x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
                assert a == b or set(signatures(x, bands)) & set(signatures(y, bands))


def test_shingles_lower_only_ascii():
    assert set(shingle_set("Ä B c", 3)) != set(shingle_set("ä b c", 3))
    assert set(shingle_set("A\tB\x0bC", 3)) == set(shingle_set("a b c", 3)) and len(shingle_set(None, 3)) == 0


@pytest.mark.parametrize("n,percent", [(4, 85)])
def test_jaccard_components_equal_brute_force(spark, near_rows, n, percent):
    package_on_workers(spark)
    docs = spark.createDataFrame([(*r, 1) for r in near_rows], "doc_id long, text string, rep int")
    got = sorted((tuple(r) for r in jaccard_components(docs, n, percent).collect()), key=str)
    assert got == sorted(brute.jaccard_components(near_rows, n, percent), key=str)


def test_one_of_each_keeps_the_smallest_id(spark, near_rows):
    docs = spark.createDataFrame([(*r, 1) for r in near_rows], "doc_id long, text string, gone_id int")
    expect = brute.jaccard_components(near_rows, 5, 80)
    stays = {d for d, _, c in expect if d is None or d == c}
    got = one_of_each(docs, 5, 80)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == stays
    empty = docs.limit(0)
    assert one_of_each(empty, 5, 80).count() == 0


def test_one_row_of_each_component(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(None, a), (7, a + " tail"), (None, a), (5, b), (5, b), (5, b), (8, c), (9, c + " tail"), (9, d),
            (None, "lone text of its own here"), (None, "lone text of its own here"), (None, None), (None, None), (6, "")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, place int")
    stays = [(5, b), (6, ""), (7, a + " tail"), (8, c), (9, d), (None, None), (None, None), (None, "lone text of its own here")]

    def kept(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    assert kept(corpus_pipeline.drop_near_copies(spark, docs, "")) == sorted(stays, key=str)
    assert kept(one_of_each(docs)) == sorted([*stays, (None, a)], key=str)


def test_forest_search_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8)).round(2)
    x[400:520] = x[7]                       # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (920, [0.0] * 8), (940, [1.0] * 7 + [None]), (960, [1.0] * 7 + [float("nan")]), (980, [1.0] * 7),
             (None, [1.0] * 8), (20, x[20].tolist())]
    v = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in forest_search(v, target=0.98).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 20))
    hit = 0
    for q, found in got.items():
        s = np.zeros(len(x))
        for d in range(8):
            s += x[:, d] * x[q, d]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -s))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and len({f[1] for f in found}) == 20
        assert all(f[2] == s[f[1]] for f in found)
        assert found == [(k + 1, i, sc) for k, (sc, i) in enumerate(sorted(((f[2], f[1]) for f in found),
                                                                          key=lambda p: (-p[0], p[1])))]
        hit += len({f[1] for f in found} & set(best.tolist()))
    assert hit / (20 * len(got)) >= 0.9
    assert forest_search(v.limit(0)).count() == 0


def test_balanced_shards(spark):
    texts = ["hot"] * 300 + [f"pair{i // 2}" for i in range(100)] + [f"single {i}" for i in range(237)] + [None, "", "é"]
    docs = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, shard int")
    got = balanced_shards(docs).collect()
    per = {}
    for r in got:
        per.setdefault(r.shard, []).append(r.slot)
    sizes = [len(s) for s in per.values()]
    assert len(got) == len(texts) and len(per) == 24 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    import zlib
    by_id = {r.doc_id: r for r in got}
    assert by_id[len(texts) - 1].size == 10 and by_id[len(texts) - 1].text_crc32 == zlib.crc32("é".encode())
    assert by_id[len(texts) - 3].size == 8 and by_id[5].grown_shard is None and by_id[5].law == "rows"
    pairs = {}
    for i, t in enumerate(texts):
        if t and t.startswith("pair"):
            pairs.setdefault(t, set()).add(by_id[i].shard)
    assert sum(len(s) > 1 for s in pairs.values()) <= 2      # cut pairs
    assert balanced_shards(docs.limit(0)).count() == 0


def test_full_shards_give_up_rows_of_the_largest_group(spark):
    rng = random.Random(1)
    texts = ["hot"] * 4000
    while len(texts) < 8000:
        texts += [f"group {len(texts)}"] * rng.randint(2, 100)
    texts += [f"single {i}" for i in range(12_000 - len(texts))]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = balanced_shards(docs).collect()
    counts, shards = {}, {}
    for r in got:
        counts[r.shard] = counts.get(r.shard, 0) + 1
        if texts[r.doc_id].startswith("group"):
            shards.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert len(got) == len(texts) and set(counts.values()) == {500}
    assert sum(len(s) > 1 for s in shards.values()) <= 5      # cut small groups, of 74


def test_one_of_each_keeps_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(5, 1, text, 7, "a"), (6, 2, text, 8, "b"), (7, 3, None, 9, "c")],
                                 "__row long, doc_id long, text string, sig long, __doc string")
    got = jaccard_join.one_of_each(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} == {(5, 1, text, 7, "a"), (7, 3, None, 9, "c")}


def test_written_signatures_or_not_give_the_same_components(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plain = {tuple(r) for r in jaccard_join.jaccard_components(rows, 5, 80).collect()}
    assert {tuple(r) for r in jaccard_join.jaccard_components(rows, 5, 80, numbered=True).collect()} == plain


def template_pages(pages: int, seed: int = 4) -> list[tuple[int, str]]:
    """Pages of 250 equal words and 60 of their own (similarity about 0.67), and
    a near copy of every 20th."""
    draw = random.Random(seed)
    frame = [f"t{i}" for i in range(250)]
    rows = []
    for i in range(pages):
        own = [f"o{draw.getrandbits(40)}" for _ in range(60)]
        rows.append((2 * i, " ".join(frame[:125] + own + frame[125:])))
        if i % 20 == 0:
            rows.append((2 * i + 1, " ".join(frame[:125] + own[:-1] + frame[125:])))
    return rows


def test_template_pages_meet_only_their_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", 128)  # fewer than the pages
    rows = template_pages(400)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


@pytest.mark.parametrize("hot_rows", [1, 3])
def test_refined_signatures_and_cells_lose_no_link(spark, near_rows, monkeypatch, hot_rows):
    """Without star rounds and with nearly every signature refined."""
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(jaccard_join, "LEADERS", 0)
    docs = spark.createDataFrame(near_rows, "doc_id long, text string")
    got = sorted(map(str, jaccard_join.jaccard_components(docs, 3, 80).collect()))
    monkeypatch.undo()
    assert got == sorted(map(str, jaccard_join.jaccard_components(docs, 3, 80).collect()))


def test_pairs_apart_are_all_pairs_of_a_group_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", 4)
    rows = [(sig, rep, rep % 7, 100, 1, *[0] * len(jaccard_join.SHORT)) for sig in (1, 2) for rep in range(23 * sig)]
    shape = "sig long, rep long, comp long, n long, band int, " + ", ".join(f"{c} long" for c in jaccard_join.SHORT)
    held = spark.createDataFrame(rows, shape)
    got = [(r.a, r.b) for r in jaccard_join.pairs_apart(*jaccard_join.in_cells(held), 80, F.lit(True)).collect()]
    assert sorted(got) == [(a, b) for a in range(46) for b in range(a + 1, 46) if a % 7 != b % 7]
