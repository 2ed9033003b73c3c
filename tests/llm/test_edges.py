"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator."""

import public_tokenizers
import pytest

import corpus_pipeline
from barloom.llm import (
    byte_bpe, collocations, decontaminate, filter_audit, licenses, line_dedup, quality_model, quality_rules, sharding, simhash,
    substring_dedup, toxicity, warc_bundles,
)
from barloom.llm.queries import judged

LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(60_000))
ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, LONG), (4, LONG), (5, "same text of a few words here"), (None, "no id at all"), (None, None)]


@pytest.fixture
def odd(docs_of, clashing):
    return clashing(docs_of(ROWS))


@pytest.fixture
def none(docs_of, clashing):
    return clashing(docs_of([(0, "x")])).limit(0)


@pytest.fixture
def bench(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, LONG[5000:5200]), (None, LONG[9000:9300])], "item_id int, text string")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (5, 0, 0), (None, 1, 1), (2, None, None)], "doc_id bigint, quality int, toxic int")


def test_quality_rules(odd, none):
    got = quality_rules.with_verdict(quality_rules.quality_measures(odd)).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r.quality_measures for r in got}
    assert by[1].n_words == 0 and by[1].base_failed and not by[1].kept and by[1].ratio == 0
    assert by[4].n_words == 60_000
    assert quality_rules.keep_good(none).columns == none.columns and quality_rules.keep_good(none).count() == 0


def test_line_dedup(odd, none):
    got = line_dedup.drop_boilerplate(odd, "source", least_pages=2, removed="removed")
    assert got.columns == [*odd.columns, "removed"]
    by = {(r.doc_id, r.text is None): r for r in got.collect()}
    assert by[1, True].removed == 0 and by[2, False].text == "" and by[3, False].text == "  \n\t "
    assert by[4, False].text == "" and by[4, False].removed == 1  # two of eight pages
    assert got.count() == len(ROWS)
    assert line_dedup.drop_boilerplate(none, "source").count() == 0


def test_line_dedup_null_hosts_are_one(spark):
    pages = spark.createDataFrame([(i, None, f"menu\nown {i}") for i in range(6)], "id int, host string, text string")
    got = line_dedup.drop_boilerplate(pages, "host", ratio=0.5)
    assert sorted(r.text for r in got.collect()) == [f"own {i}" for i in range(6)]


def test_simhash(odd, none):
    got = simhash.simhash_groups(odd).collect()
    assert len(got) == len(ROWS)
    wordless = [r for r in got if r.fingerprint == "0" * 16]
    assert len(wordless) == 4 and {r.component_id for r in wordless} == {1}
    assert [r.component_id for r in got if r.doc_id == 4] == [4, 4]
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1, r.text and r.text[:5]) for r in kept.collect()) == [(-1, "no id"), (1, None), (4, "word0"), (5, "same ")]
    assert simhash.simhash_groups(none).count() == 0 and simhash.keep_one_of_each(none).count() == 0


def test_substring_dedup(odd, none, docs_of, clashing):
    # rows of one id are one document; its text begins anew after 997 * 31 words
    (row,) = substring_dedup.repeated_passages(odd).collect()
    again = len(" ".join(LONG.split()[: 997 * 31])) + 1
    assert row.doc_id == row.first_doc_id == 4 and again <= row.start < again + 512 and len(LONG) - 512 < row.stop <= len(LONG)
    once = " ".join(f"word{i}x{i % 31}" for i in range(60_000))
    twice = clashing(docs_of([(1, once), (2, once), (3, None), (None, once)]))
    rows = substring_dedup.repeated_passages(twice).collect()
    assert [(r.doc_id, r.start, r.stop, r.first_doc_id) for r in rows] == [(2, 0, len(once), 1)]
    left = {(r.doc_id, None if r.text is None else len(r.text)) for r in substring_dedup.drop_repeats(twice).collect()}
    assert left == {(1, len(once)), (2, 0), (3, None), (None, len(once))}
    assert substring_dedup.repeated_passages(none).count() == 0


def test_decontamination(odd, none, bench):
    got = decontaminate.contaminated(odd, bench).collect()
    assert sorted((r.doc_id, r.item_id or -1, r.edits) for r in got) == [(4, -1, 0), (4, -1, 0), (4, 3, 0), (4, 3, 0)]
    kept = decontaminate.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == len(ROWS) - 2
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(odd, bench.limit(0)).count() == len(ROWS)


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality_model, "quality")])
def test_classifiers(odd, none, labels, module, label):
    model = module.train(odd, labels, label=label)
    got = judged(model.scored(odd.drop("score")), 0.5).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out is False for r in got if r.doc_id is None)
    assert model.scored(none.drop("score")).count() == 0
    untaught = module.train(odd, labels.limit(0), label=label)
    assert all(abs(r.score - 0.5) < 0.2 for r in untaught.scored(odd.drop("score")).collect())


def test_licences(odd, none, docs_of):
    assert licenses.licence_scan(odd).count() == 0 and licenses.licence_scan(none).count() == 0
    text = LONG + ".\nReleased under the MIT License.\n" + LONG
    assert [r.licenses for r in licenses.licence_scan(docs_of([text, text])).collect()] == ["MIT", "MIT"]


def test_byte_bpe(spark, odd, none):
    bpe = byte_bpe.ByteBPE(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = byte_bpe.token_digests(bpe, odd).collect()
    assert len(got) == len(ROWS)
    assert [r.n_tokens for r in got if r.doc_id in (1, 2)] == [0, 0]
    assert byte_bpe.token_digests(bpe, none).count() == 0


def test_pipeline_stages(spark, odd, none, tmp_path, bench):
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for frame in (odd, none):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == frame.columns
            docs.collect()
        assert {"doc_id", "ids"} <= set(corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).columns)


def test_warc(spark, tmp_path):
    big = "ä" * 700
    rows = [(1, "http://a", big), (7, "http://b/\r\nx", big), (7, "http://b", big), (3, None, None), (None, None, big), (4, "u", "x" * 999), (5, "u", "x" * 999)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    index = warc_bundles.write_bundles(pages, str(tmp_path / "w"), settings=warc_bundles.Bundles(frame_bytes=1500, bundle_bytes=3000))
    got = warc_bundles.read_bundles(spark, str(tmp_path / "w"), keep_payload=True).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got) == [
        (0, "revisit", 7, 1400), (1, "revisit", 7, 1400), (3, "response", None, 0), (4, "response", None, 999),
        (5, "response", None, 999), (7, "response", None, 1400), (7, "response", None, 1400),
    ]
    wanted = index.filter("page_id = 4")
    found = warc_bundles.fetch(index, wanted, str(tmp_path / "w")).collect()
    assert [(r.page_id, bytes(r.payload)) for r in found] == [(4, b"x" * 999)]
    assert warc_bundles.round_trip(pages.limit(0)).count() == 0


def test_bundles_of_other_attempts_are_not_read(spark, tmp_path):
    """A repeated attempt packs otherwise and a broken one leaves half a file: the index names neither."""
    pages = spark.createDataFrame([(i, "u", f"{i}" * 900) for i in range(40)], "page_id bigint, url string, html string").coalesce(1)
    other, folder = tmp_path / "other", tmp_path / "w"
    warc_bundles.write_bundles(pages, str(other), settings=warc_bundles.Bundles(frame_bytes=2000, bundle_bytes=500))
    index = warc_bundles.write_bundles(pages, str(folder), settings=warc_bundles.Bundles(frame_bytes=4000, bundle_bytes=2000))
    named = {r.bundle for r in index.select("bundle").distinct().collect()}
    for file in other.glob("*.warc.zst"):
        (folder / f"part-00000-0000-99{file.name}").write_bytes(file.read_bytes())
    (folder / "part-00000-0001-77.warc.zst").write_bytes(next(other.glob("*.warc.zst")).read_bytes()[:50])
    assert len(list(folder.glob("*.warc.zst"))) > len(named)
    assert sorted(r.page_id for r in warc_bundles.read_bundles(spark, str(folder)).collect()) == list(range(40))
    assert sorted(r.page_id for r in warc_bundles.fetch(index, index, str(folder)).collect()) == list(range(40))


def test_one_of_each_where_ids_repeat(docs_of):
    """An id in two groups stands for each on its own."""
    a, b = "the first text of some length here", "another one with quite different words inside"
    kept = simhash.keep_one_of_each(docs_of([(3, a), (5, a), (5, b)])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, a), (5, b)]
    kept = simhash.keep_one_of_each(docs_of([(5, b), (5, a), (7, b), (5, b), (None, a), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(0, ""), (5, a), (5, b)])


def test_a_column_is_never_replaced(odd, docs_of, labels):
    model = toxicity.train(odd, labels, label="toxic")
    with pytest.raises(ValueError, match="score"):
        model.scored(odd)
    with pytest.raises(ValueError, match="simhash"):
        simhash.fingerprints(docs_of(["x"]).withColumnRenamed("lang", "simhash"), into="simhash")


def test_columns_with_a_dot(docs_of):
    docs = docs_of([(1, "some words of a text"), (2, None)]).withColumnRenamed("text", "the.text")
    assert quality_rules.quality_measures(docs, "the.text").count() == 2
    assert simhash.fingerprints(docs, "the.text").count() == 2
    assert simhash.keep_one_of_each(docs, text="the.text").count() == 2
    assert sharding.sharded(docs, "the.text").count() == 2
    assert filter_audit.filter_interactions(docs, docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic"), text="the.text").count() == 600
    assert line_dedup.drop_boilerplate(docs, "source", text="the.text").count() == 2


def test_sharding(odd, none):
    got = sharding.sharded(odd, shards=3).collect()
    assert len(got) == len(ROWS) and {c for c in got[0].asDict()} == {"doc_id", "size", "text_crc32", "shard", "slot"}
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert len({r.shard for r in got if r.doc_id == 4}) == 1  # the copies of the long text
    assert len({r.shard for r in got if r.size == 1}) == 1 and {r.text_crc32 for r in got if r.size == 1} == {0}
    assert sharding.sharded(none).count() == 0
    with pytest.raises(ValueError, match="size"):
        sharding.sharded(odd.withColumnRenamed("lang", "size"), keep=("doc_id", "size"))


def test_filter_audit(odd, none, labels):
    rows = filter_audit.filter_interactions(odd, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {"s"}
    for order in {r.filter_order for r in rows}:
        steps = sorted((r for r in rows if r.filter_order == order), key=lambda r: r.step)
        assert sum(r.removed for r in steps) + steps[-1].kept == len(ROWS)
    parts = filter_audit.filter_interactions(odd.selectExpr("doc_id", "text", "IF(doc_id = 4, NULL, '') AS source", "score"), labels)
    assert parts.select("part").distinct().count() == 1
    assert filter_audit.filter_interactions(none, labels).count() == 0
    assert filter_audit.filter_interactions(odd, labels.limit(0)).agg({"good_lost": "max"}).first()[0] == 0


def test_collocations(odd, none, spark):
    assert collocations.collocations(odd).count() == 0  # no phrase of these rows occurs ten times, the most is four
    got = collocations.collocations(odd, mining=collocations.Mining(least=4)).collect()
    assert got and {r.lang for r in got} == {"en"} and [r.rank for r in got] == list(range(1, len(got) + 1))
    assert collocations.collocations(none).count() == 0
    blank = spark.createDataFrame([(None, None), ("", ""), ("x", " ,; \t\n."), (None, "a b " * 20)], "lang string, text string")
    rows = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n) for r in collocations.collocations(blank).collect()}
    # "a b" and "a" score 19 * 19 / (20 * 20), less than "a" and "b a" with 19 * 19 / (20 * 19)
    assert set(rows) == {("und", "a b a"), ("und", "b a b")} and rows["und", "a b a"] == (19, 20, 20, 40)
