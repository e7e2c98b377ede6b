"""The text operators against SQL, brute force, exact round trips and held-out labels."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from coppice.llm import (
    bpe,
    chunks,
    exact_dedup,
    mixing,
    preference,
    quality,
    resampling,
    simhash,
    templates,
    toxicity,
)
from coppice.llm.components import components
from coppice.llm.oracles import ORACLES
from coppice.llm.queries import QUERIES, vocabulary
from oracle import connect, differences

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _copy string, size int"
LONG = "word " * 40_000 + "x" * 30_000


def doc(doc_id, text, source="a"):
    return (doc_id, text, "en", source, 0, "mine", 7)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rows = [
        doc(1, None, None), doc(2, ""), doc(3, LONG), doc(4, "a  b\tc"), doc(5, "a b c"),
        doc(5, "a b c"), doc(6, " \n "), (7, "ü <|endoftext|> ß", None, "b", None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir):
    with connect(sf_dir) as con:
        extra, missing = differences(con, QUERIES[name](spark, sf_dir), ORACLES[name])
    assert not extra and not missing, (list(extra)[:3], list(missing)[:3])


@pytest.mark.parametrize("name", ["op4_mixing", "op6_quality_rules", "op7_exact_dedup"])
def test_odd_rows_equal_sql(name, spark, odd, empty, tmp_path):
    for i, table in enumerate((odd, empty)):
        folder = tmp_path / str(i)
        table.coalesce(1).write.parquet(str(folder / "documents.parquet"))
        with connect(str(folder / "none")) as con:
            con.execute(
                f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')"
            )
            extra, missing = differences(con, QUERIES[name](spark, str(folder)), ORACLES[name])
        assert not extra and not missing, (list(extra), list(missing))


def test_bpe_equals_the_tokenizers_library(spark, sf_dir, odd, empty):
    tool = Tokenizer.from_file(vocabulary())
    for table in (odd, empty, spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 300")):
        expected = Counter()
        for row in table.collect():
            ids = tool.encode(row["text"] or "", add_special_tokens=False).ids
            text = tool.decode(ids, skip_special_tokens=False)
            packed = np.array(ids, dtype="<u4").tobytes()
            expected[
                row["doc_id"],
                len(ids),
                hashlib.sha256(packed).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest(),
            ] += 1
        assert Counter(tuple(r) for r in bpe.round_trip(table, vocabulary()).collect()) == expected
    back = bpe.decoded(bpe.encoded(odd, vocabulary()), vocabulary())
    assert Counter(r["text"] for r in back.collect()) == Counter(
        r["text"] or "" for r in odd.collect()
    )


def test_short_and_long_merges_agree():
    codec = bpe.codec(vocabulary())
    rng = random.Random(1)
    for n in (1, 2, 7, 40, 64):
        ids = [codec.byte_ids[rng.choice(b"abethinor ")] for _ in range(n)]
        assert codec._merge_short(list(ids)) == codec._merge_long(list(ids))


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest doc_id reachable over fingerprints that differ in at most two bits."""
    root = {f: f for f in prints.values()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 2:
            root[find(b)] = find(a)
    least = {}
    for doc_id, f in prints.items():
        least[find(f)] = min(least.get(find(f), doc_id), doc_id)
    return {doc_id: least[find(f)] for doc_id, f in prints.items()}


def test_simhash_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in rows}
    expected = brute_components(prints)
    got = QUERIES["op10_simhash"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{f:016x}" for d, f in prints.items()}


@pytest.mark.parametrize("crowded", [2, 64])
def test_links_of_crowded_signatures(spark, monkeypatch, crowded):
    """Chains, pairs in one half or both, and a dense cluster; with and without the second index."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(50)}
    base = rng.getrandbits(64)
    for _ in range(150):
        values.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    chain = rng.getrandbits(64)
    for bit in range(0, 60, 2):
        values.add(chain := chain ^ (3 << bit))
    prints = dict(enumerate(sorted(values)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints.values()]
    roots = components(simhash.links(spark.createDataFrame(signed, "fp long")))
    of = {r["node"]: r["root"] for r in roots.collect()}
    groups = Counter(of.get(s, s) for (s,) in signed)
    expected = Counter(brute_components(prints).values())
    assert sorted(groups.values()) == sorted(expected.values())


def test_simhash_of_odd_rows(odd, empty):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_groups(odd).collect()}
    assert {(1, 1), (2, 1), (6, 1), (4, 4), (5, 4)} <= got
    assert simhash.near_groups(empty).count() == 0
    assert simhash.without_near(odd).columns == odd.columns


def test_dedup_of_null_and_repeated_ids_goes_by_row(spark):
    """A row's copy takes along neither rows without an id nor other texts of its id."""
    texts = [f"{w} first {w} second {w} third {w} fourth" for w in ("red", "blue", "green", "grey")]
    red, blue, green, grey = texts
    rows = [(1, red), (None, red), (None, blue), (None, green), (None, green), (2, grey), (2, grey)]
    rows += [(3, red), (3, "a text of its own under a repeated id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("mine"))
    expected = sorted([(1, red), (-1, blue), (-1, green), (2, grey), (3, rows[-1][1])])
    for stage in (exact_dedup.without_copies, simhash.without_near):
        out = stage(df)
        assert out.columns == df.columns
        assert sorted((-1 if r[0] is None else r[0], r[1]) for r in out.collect()) == expected


def test_colliding_digests_keep_texts_apart(spark):
    rows = [(i, f"text {i % 40}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.marked_copies(df, digest_bits=8).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [
        (i, i % 40, 10) for i in range(400)
    ]
    assert sorted(r["doc_id"] for r in exact_dedup.without_copies(df).collect()) == [*range(40)]


def test_mix_repeats_rows_near_their_targets(spark, odd, empty):
    rows = [doc(i, "w " * 20, f"s{i % 3}" if i % 10 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix_plan(df).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("c")
    )
    for r in plan.collect():
        assert abs(r["taken"] / r["target"] - 1) < 0.15 and r["c"] <= 3
    copies = mixing.mixed(df)
    assert copies.columns == df.columns
    taken = mixing.mix_plan(df).agg(F.sum("copies")).first()[0]
    assert copies.count() == taken
    assert mixing.mixed(empty).count() == 0 and mixing.mixed(odd).columns == odd.columns


def test_rules_drop_junk_and_keep_clean_rows(spark, sf_dir, odd):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    shares = QUERIES["op6_quality_rules"](spark, sf_dir).filter("n_words >= 50").join(labels, "doc_id")
    kept = {r["quality"]: r["k"] for r in shares.groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.1
    assert quality.passing(odd).columns == odd.columns


def test_preference_of_common_prefixes(spark):
    turns = [
        (1, 0, "user", "hi", 1), (1, 1, "assistant", "x", 1), (1, 2, "user", "more", 1),
        (2, 0, "user", "hi", 1), (2, 0, "user", "hi", 1), (2, 1, "assistant", "y", 1),
        (3, 0, None, None, 1), (3, None, "user", "first", 1), (None, 0, "user", "lost", 1),
    ]
    raw = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, part int")
    clean = preference.clean_turns(raw)
    pairs = spark.createDataFrame(
        [(0, 1, 2), (1, 3, 3)], "pair_id long, chosen_id long, rejected_id long"
    )
    rows = preference.preference_rows(clean, pairs.filter("pair_id = 0"))
    got = sorted((r["segment"], r["turn"], r["loss"]) for r in rows.collect())
    assert got == [
        ("chosen", 1, True), ("chosen", 2, False), ("prompt", 0, False), ("rejected", 1, True)
    ]
    same = preference.preference_rows(clean, pairs.filter("pair_id = 1"))
    assert {r["segment"] for r in same.collect()} == {"prompt"}
    assert preference.pairs_by_opening(clean.limit(0)).count() == 0


def test_chunk_boundaries_resist_shifts():
    settings, gear = chunks.ChunkSettings(), chunks.gear_table(42)
    rng = random.Random(3)
    body = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(400)).encode()

    def parts(data):
        ends = chunks.boundaries(data, gear, settings)
        assert ends[-1] == len(data) and max(np.diff([0, *ends])) <= settings.max_bytes
        return {data[a:b] for a, b in zip([0, *ends], ends, strict=False)}

    slow, h = [], 0
    for i, b in enumerate(body):
        h = ((h << 1) + int(gear[b])) & 0xFFFF
        slow += [i + 1] if i >= 15 and h >> 11 == 0 else []
    assert {e for e in chunks.boundaries(body, gear, settings)} & set(slow)
    assert len(parts(body) & parts(b"inserted " + body)) > 0.95 * len(parts(body))


def test_passages_across_documents(spark, odd, empty):
    rng = random.Random(4)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))

    shared = words(55)
    rows = [(i, words(80) + " " + (shared if i % 4 == 0 else words(30)) + words(60)) for i in range(60)]
    got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == {i for i in range(60) if i % 4 == 0}
    assert {r["first_doc_id"] for r in got} == {0}
    for r in got:
        span = rows[r["doc_id"]][1].encode()[r["start"] : r["end"]].decode()
        assert span in shared and r["kept"] == (r["doc_id"] == 0)
    assert chunks.repeated_passages(empty).count() == 0
    assert {r["doc_id"] for r in chunks.repeated_passages(odd).collect()} == set()


def test_block_max_search_is_exact():
    rng = np.random.default_rng(7)

    def vector():
        terms = np.sort(rng.choice(40, rng.integers(0, 8), replace=False)).astype(np.int64)
        w = rng.random(len(terms)) + 0.1
        return terms, w / np.sqrt((w**2).sum()) if len(w) else w

    vectors = [vector() for _ in range(300)]
    index = toxicity.BlockMaxIndex(vectors, 40, 16)
    for q in [vector() for _ in range(60)]:
        dense = np.zeros(40)
        dense[q[0]] = q[1]
        cosines = [(float((dense[t] * w).sum()), i) for i, (t, w) in enumerate(vectors)]
        exact = sorted((c for c in cosines if c[0] > 0), key=lambda c: (-round(c[0], 9), c[1]))[:10]
        got = index.nearest(*q, 10)
        assert np.allclose([c for c, _ in got], [c for c, _ in exact])


def test_toxicity_on_held_out_rows(spark, odd, empty):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    result = QUERIES["op2_toxicity"](spark, folder).filter("held_out").join(labels, "doc_id")
    rows = result.select("score", "predicted", "toxic").collect()
    assert sum(r["predicted"] for r in rows if r["toxic"]) > 0.65 * sum(r["toxic"] for r in rows)
    assert sum(r["predicted"] for r in rows if not r["toxic"]) < 0.01 * len(rows)
    few = spark.createDataFrame([(4, 1, 1), (5, None, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.fitted(odd, few)
    got = toxicity.scored(odd, model).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scored(empty, model).count() == 0


def test_resampling_prefers_target_text(spark, sf_dir, odd, empty):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = QUERIES["op9_quality_classifier"](spark, sf_dir).join(labels, "doc_id", "left")
    rows = got.filter(F.col("quality").isNotNull()).collect()
    good_keys, bad_keys = ([r["log_weight"] for r in rows if r["quality"] == q] for q in (1, 0))
    wins = np.mean([[g > b for b in bad_keys] for g in good_keys])
    assert wins > 0.95
    assert np.mean([r["selected"] for r in rows if r["quality"] == 1]) > 0.97
    good = odd.filter("doc_id = 5").select("doc_id")
    assert resampling.resampled(odd, good).count() == 8
    assert resampling.resampled(empty, good.limit(0)).count() == 0


HTML = (
    "<html><head><title>no</title><script>var a='</p>'</script></head><body><nav><a href=/>Home</a>"
    "</nav><div class='cookie-notice'>We use</div><article><h1>Tom &amp; {0}</h1><p>One\n  <b>two</b> {0}"
    "<p>Three<!-- no --></p><div class=comments>nice {0}</div></article><aside>side {0}</aside>"
    "<footer>&copy; x</footer></body></html>"
)


def test_main_text_of_pages(spark):
    rows = [(i, "https://h.example/" + str(i), HTML.format(f"w{i}"), "t") for i in range(8)]
    rows += [(8, None, None, "t"), (9, "not a url", "", "t"), (10, "http://o.example/", "<p>Alone", "t")]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in templates.extracted(df).collect()}
    for i in range(8):
        text = f"Tom & w{i}\nOne two w{i}\nThree"
        assert got[i] == (text, len(text))
    assert got[8] == got[9] == ("", 0) and got[10] == ("Alone", 5)
    assert templates.extracted(df.limit(0)).count() == 0


def test_template_text_without_article_is_left_out(spark):
    page = "<body><div id=top>Same line</div><div id=c><p>Read on</p><p>Body of {0} is long {0}</p></div>"
    rows = [(i, "https://h.example/", page.format(f"v{i}")) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in templates.extracted(df).collect()}
    assert got == {i: f"Body of v{i} is long v{i}" for i in range(9)}


def test_pipeline_equals_its_stages_done_plainly(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in quality.judged(docs).filter("kept").collect()}
    rows = {r["doc_id"]: r for r in docs.collect() if r["doc_id"] in kept}
    first = {}
    for doc_id in sorted(rows):
        first.setdefault(" ".join(f".{rows[doc_id]['text']}.".replace("\n", " ").split(" ")), doc_id)
    rows = {d: rows[d] for d in first.values()}
    near = brute_components({d: slow_fingerprint(r["text"]) for d, r in rows.items()})
    left = docs.filter(F.col("doc_id").isin([d for d in rows if near[d] == d]))
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(left).collect()}
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == Counter({d: n for d, n in plan.items() if n})
