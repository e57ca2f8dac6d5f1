"""Small inputs with known results."""

import random
import time
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from scholmill.functions import normalize as N
from scholmill.functions.statistics import linear_percentiles
from scholmill.operators import articles as A
from scholmill.operators import cohorts as C
from scholmill.operators import extract as E
from scholmill.operators import indicators as I
from scholmill.operators import integrate as G
from scholmill.operators import metadata as M
from scholmill.operators import quantiles as Q
from scholmill.plans import queries as PQ
from scholmill.operators.components import components
from scholmill.operators.durable import cut
from scholmill.sources import articles as SA
from scholmill.sources import works as SW
from scholmill.streaming.incremental import extract_new_files

WORKS = "publication_year int, journal_id string, journal_issn_l string, language string, is_merged boolean, oa_individual_works string, domain string, field string, subfield string, topic string, citations_total long, citations_window_2y long, citations_window_3y long, citations_window_5y long, is_journal_oa int, citations_2024 long, citations_2025 long, work_id string, doi string"


@pytest.fixture(scope="module")
def works(spark):
    both = '{"W1":{"language":"en"},"W2":{"language":"pt"}}'
    rows = [
        (2020, "S1", "I1", "en", True, both, "d", "Arts'", "s", "t", 20, 2, 3, 4, 1, 5, 6, "W1", "https://doi.org/10/A"),
        (2020, "S1", "I1", "pt", False, None, "d", "Arts'", "s", "t", 10, 2, 3, 4, 1, 1, 1, "W2", "doi:10/b"),
        (2020, "S2", "I2", "en", None, "not-json", "d", "Arts'", "s", "t", 5, 0, 3, 4, 0, 0, 0, "W3", "10/c"),
        (2020, None, "I3", "en", None, None, "d", "Other", "s", "t", None, None, 0, 0, 0, None, 0, "W4", None),
        (2021, "S1", None, "en", None, None, "d", "Arts'", None, None, 7, 1, 1, 1, 0, 0, 0, "W5", "10/e"),
    ]
    return spark.createDataFrame(rows, WORKS)


def test_scalars(spark):
    one = lambda c, v, t="string": spark.createDataFrame([(v,)], f"x {t}").select(c("x").alias("y")).first()[0]
    assert [one(N.doi, v) for v in (None, "", " HTTPS://doi.org/10.1/A ", "doi:10.1/x ", "http://dx.doi.org/1")] == ["", "", "10.1/a", "10.1/x", "http://dx.doi.org/1"]
    assert [one(N.title_key, v) for v in (None, "", " Ação É ﬁm", "A b\tC\n", "ÀB")] == ["", "", "acaoefim", "ab\tc", "ab"]
    assert [one(N.year, v) for v in (None, "", " 1799 ", "2027", "20x", "1.5", "+12", "99999999999")] == [None, None, 1799, 2027, None, None, 12, None]
    assert [one(N.flag, v) for v in (None, "", "Sim", " y ", "2", "true", "no")] == [0, 0, 1, 1, 0, 1, 0]
    assert one(lambda x: N.flag(x, "int"), 2, "int") == 1 and one(lambda x: N.flag(x, "double"), float("nan"), "double") == 0 and one(lambda x: N.flag(x, "boolean"), None, "boolean") == 0
    assert [one(N.journal_id, v) for v in (None, "  ", "S1", " https://openalex.org/S1 ", "x")] == [None, None, "https://openalex.org/S1", "https://openalex.org/S1", "x"]
    assert [one(N.short_id, v) for v in (None, "https://openalex.org/S1", "S2")] == [None, "S1", "S2"]
    assert [one(N.text, v) for v in (None, " a ")] == ["", "a"] and one(N.count, None, "long") == 0
    assert one(N.merged_languages, '{"W1":{"language":" EN"},"W2":{"language":"pt"},"W3":5,"W4":{}}') == ["en", "pt"]
    assert one(N.merged_languages, "not-json") == one(N.merged_languages, None) == one(N.merged_languages, "[1]") == []
    assert N.threshold_name(99) == "top_1pct_all_time_citations_threshold" and N.threshold_name(90, 3) == "top_10pct_window_3y_citations_threshold"
    assert N.percent_list("50, 99,90,") == [99, 90, 50] and N.header("a_b_c") == "a b c"


def test_linear_percentiles(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    assert df.select(linear_percentiles("x", [0.0, 0.5, 0.9])).first()[0] == [1.0, 2.5, pytest.approx(3.7)]
    assert df.limit(0).select(linear_percentiles("x", [0.5])).first()[0] == [0.0]
    with pytest.raises(ValueError):
        linear_percentiles("x", [50])


def test_cohorts(spark, works):
    base = C.cohort_baseline(works, ("field",), [2020], only=["Arts'"]).collect()
    assert len(base) == 1 and base[0].category_publications_count == 3 and base[0].category_citations_total == 35 and base[0].category_citations_mean == pytest.approx(35 / 3)
    t = C.cohort_thresholds(works, ("field",), [2020], only=["Arts'"]).first()
    assert t.top_50pct_all_time_citations_threshold == 10 and t.top_50pct_window_2y_citations_threshold == 2
    one = C.cohort_thresholds(works, ("field",), [2020], threshold_mode="floor_plus_one", only=["Arts'"]).first()
    assert one.top_50pct_all_time_citations_threshold == 11
    key = lambda r: tuple(map(str, r))
    for kw in ({}, {"percentiles": (75,), "windows": ()}):
        a, b, c = C.cohort_thresholds(works, **kw), C.cohort_thresholds_histogram(works, **kw), C.cohort_thresholds_bracketed(works, **kw)
        assert a.columns == b.columns == c.columns and sorted(map(key, a.collect())) == sorted(map(key, b.collect())) == sorted(map(key, c.collect()))
    with pytest.raises(ValueError):
        C.cohort_baseline(works, ("field; drop",))
    with pytest.raises(ValueError):
        C.cohort_thresholds(works, threshold_mode="other")
    assert [r.n_issns for r in C.issn_conflicts(works.unionByName(works.withColumn("journal_issn_l", F.lit("X"))), ("domain",), [2020]).collect()] == [2, 2]


def test_bracketed_selection(spark):
    """Few values and many, ties, negative and very large values, and a group with most rows."""
    import random

    rnd = random.Random(5)
    draw = [lambda: rnd.randrange(3), lambda: rnd.randrange(-5000, 10**6), lambda: int(rnd.paretovariate(0.4)) % 2**62 * rnd.choice((1, -1)), lambda: rnd.choice((2**63 - 1, -(2**63), 127, 128, -128, -129, 2**40 + rnd.randrange(9)))]
    data = [(g, draw[g % 4](), draw[(g + 1) % 4]()) for g in range(7) for _ in range(3000 if g == 2 else (1, 5, 90, 700)[g % 4])]
    df = spark.createDataFrame(data, "g int, x long, y long").repartition(3)
    ranks = [Q.percentile(f"{c}{p}", c, p) for c in "xy" for p in (1, 50, 95, 99, 100)] + Q.middle("x", "lower", "upper")
    count = lambda d: d.groupBy("g").agg(F.max("x").alias("top"), F.count("*").alias("n"))
    got = {r.g: r for r in Q.settle(count(df), df, ["g"], ranks).collect()}
    assert len(got) == 7
    for g, r in got.items():
        xs, ys = sorted(d[1] for d in data if d[0] == g), sorted(d[2] for d in data if d[0] == g)
        for c, vs in (("x", xs), ("y", ys)):
            assert [r[f"{c}{p}"] for p in (1, 50, 95, 99, 100)] == [vs[max(-(-p * len(vs) // 100), 1) - 1] for p in (1, 50, 95, 99, 100)]
        assert (r.lower, r.upper) == (xs[(len(xs) + 1) // 2 - 1], xs[len(xs) // 2]) and (r.n, r.top) == (len(xs), xs[-1])
    assert Q.settle(count(df.limit(0)), df.limit(0), ["g"], ranks).count() == 0


def test_indicators(spark, works):
    out = {(r.publication_year, r.journal_id): r for r in I.build_indicators(works, levels=("field",), only=["Arts'"]).collect()}
    s1, s2 = out[2020, "S1"], out[2020, "S2"]
    assert s1.journal_publications_count == 2 and s1.journal_citations_total == 30 and s1.top_50pct_all_time_publications_count == 2
    assert s1.is_journal_multilingual == 1 and s2.is_journal_multilingual == 0 and s1.citations_2024 == 6 and s1.journal_title == "S1"
    assert s1.journal_impact_cohort == pytest.approx(15 / (35 / 3)) and s1.category_publications_median == 1.5 and s1.top_50pct_all_time_publications_share_pct == 100
    assert s2.citations_window_2y_works == 0 and s2.is_scielo == 0 and s2.journal_publisher == "" and len(out) == 3
    assert I.build_indicators(works, windows=(), percentiles=(50,)).columns == I.output_columns((), (50,), ("citations_2024", "citations_2025"))
    null = I.build_indicators(works.withColumn("journal_id", F.coalesce("journal_id", F.lit("S9"))), levels=("field",), only=["Other"]).first()
    assert null.top_50pct_all_time_citations_threshold == 0 and null.top_50pct_all_time_publications_count == 0 and null.journal_impact_cohort == 0
    flagged = {r.journal_id: (r.min_publications, r.is_comparable) for r in I.comparability(I.build_indicators(works, levels=("field",), years=[2020], only=["Arts'"]), least=2).collect()}
    assert flagged == {"S1": (2, 1), "S2": (2, 0)}


def test_csv(spark, works, tmp_path):
    out = I.build_indicators(works, levels=("field",))
    I.write_csv(out, f"{tmp_path}/flat")
    I.write_csv(out, f"{tmp_path}/parts", partition=True)
    back = spark.read.option("header", True).csv(f"{tmp_path}/flat")
    assert back.count() == out.count() and back.columns == [N.header(c) for c in out.columns]
    assert spark.read.option("header", True).csv(f"{tmp_path}/parts").count() == out.count()


def test_metadata(spark, works):
    names = list(M.SOURCE_NAMES.values())
    assert len(names) == 34
    row = dict.fromkeys(names, "") | {"OpenAlex ID": " S1", "YEAR": "2020", "Journal": " One ", "is SciELO": "yes", "SciELO Active and Valid in the Year": "1", "SciELO collection acronym": "scl"}
    rows = [row, dict(row), row | {"OpenAlex ID": "S2"}, row | {"OpenAlex ID": "S2", "Journal": "Two"}, row | {"OpenAlex ID": ""}, row | {"YEAR": "x"}]
    raw = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))
    meta = M.journal_metadata(raw)
    assert [(r.journal_id, r.journal_title, r.is_scielo) for r in meta.collect()] == [("https://openalex.org/S1", "One", 1)]
    with pytest.warns(UserWarning, match="YEAR"):
        assert M.journal_metadata(raw.drop("YEAR")) is None
    assert tuple(M.conflict_stats(M.normalize(raw.select(*[F.col(f"`{s}`").alias(n) for n, s in M.SOURCE_NAMES.items()]))).first()) == (0, 1, 1)
    rich = I.build_indicators(works.withColumn("journal_id", N.journal_id("journal_id")), meta, levels=("field",), years=[2020])
    got = {r.journal_id[-2:]: (r.journal_title[-3:], r.scielo_collection, r.is_scielo) for r in rich.collect()}
    assert got["S1"] == ("One", "scl", 1) and got["S2"] == ("/S2", "", 0)
    assert I.with_metadata(works.select("journal_id"), meta.drop("publication_year")).first().journal_title == "S1"


RAW = "id string, type string, is_xpac boolean, publication_year int, p string, pt string, n array<struct<year: int, cited_by_count: long>>"


def raw(spark, rows):
    df = spark.createDataFrame(rows, RAW + ", updated_date string, line_no long")
    source = "named_struct('id', p, 'type', pt, 'issn_l', 'I', 'is_oa', true)"
    return SW.parse_snapshot(df.select(F.expr(f"to_json(named_struct('id', id, 'type', type, 'is_xpac', is_xpac, 'publication_year', publication_year, 'cited_by_count', 3, 'primary_location', named_struct('source', {source}), 'locations', array(named_struct('source', {source}), named_struct('source', named_struct('id', 'L', 'type', 'journal', 'issn_l', 'I', 'is_oa', true))), 'counts_by_year', n))").alias("value"), "updated_date", F.lit("part").alias("file_path"), "line_no"))


def test_extract(spark):
    n = [(2020, 1), (2021, 2), (2021, 3), (2022, 4), (2025, 5), (0, 9)]
    rows = [
        ("W1", "article", None, 2020, "P", "journal", n, "2024-01-01", 1),
        ("W1", "article", None, 2020, "Q", "journal", n, "2024-01-02", 9),
        ("W1", "article", None, 2020, "R", "journal", n, "2024-01-02", 2),
        ("W1", "book", None, 2020, "R", "journal", n, "2024-01-03", 1),
        ("W2", "article", True, 2020, "P", "journal", n, "2024-01-01", 3),
        ("W3", "article", False, 2019, "P", "repository", None, "2024-01-01", 4),
        ("W4", "article", False, 1990, "P", "journal", n, "2024-01-01", 5),
        ("W5", "article", False, 2020, "P", "journal", [(2021, None)], "2024-01-01", 6),
    ]
    df = raw(spark, rows)
    assert E.citation_years(df) == [2020, 2021, 2022, 2025]
    got = {r.work_id: r for r in E.extract_works(df, 2018, 2025).collect()}
    assert set(got) == {"W1", "W3"} and got["W1"].journal_id == "R" and got["W3"].journal_id == "L"
    w = got["W1"]
    assert (w.citations_2021, w.citations_window_2y, w.citations_window_3y, w.citations_window_5y, w.is_journal_oa, w.citations_total) == (3, 9, 9, 14, 1, 3)
    assert got["W3"].citations_2021 is None and got["W3"].citations_window_5y == 0 and got["W3"].has_citation_window_5y == 0
    known = spark.createDataFrame([("W1", "2023-01-01")], "work_id string, updated_date string")
    assert [r.work_id for r in E.extract_works(df, 2018, 2025, years=[], known=known).collect()] == ["W3"]
    bad = spark.createDataFrame([("{", "d", 1), ('{"publication_year":"x","type":"article"}', "d", 2), (None, "d", 3)], "value string, updated_date string, line_no long")
    assert E.extract_works(SW.parse_snapshot(bad), 2018, 2025, years=[2020], order=("line_no",)).count() == 0
    assert tuple(E.dropped(df, 2018, 2025).first()) == (0, 1, 0) and tuple(E.dropped(df, 2018, 2025, windows=()).first()) == (0, 0, 0)
    assert E.dropped(SW.parse_snapshot(bad), 2018, 2025).first().n_unread == 2


def test_first_of_file_and_line(spark, tmp_path):
    """Of two versions of one date the one in the file of the smaller name counts, also where that file is read later as it is smaller."""
    import gzip
    import json

    def line(work, citations):
        source = {"id": "J", "type": "journal", "issn_l": "I", "is_oa": True}
        return json.dumps({"id": work, "type": "article", "publication_year": 2020, "cited_by_count": citations, "primary_location": {"source": source}, "locations": [{"source": source}], "counts_by_year": []})

    folder = tmp_path / "updated_date=2024-01-01"
    folder.mkdir()
    for name, lines in (("part_000.gz", [line("W1", 1), line("W1", 7)]), ("part_001.gz", [line("W1", 2)] + [line(f"X{i}", i) for i in range(3000)])):
        with gzip.open(folder / name, "wt") as f:
            f.write("\n".join(lines))
    got = E.extract_works(SW.parse_snapshot(SW.read_snapshot(spark, str(tmp_path))), 2018, 2025, years=[])
    assert got.filter("work_id = 'W1'").first().citations_total == 1 and got.count() == 3001


def test_snapshot_and_stream(spark, tmp_path):
    import gzip
    import json

    def put(date, part, *ids):
        d = tmp_path / "raw" / f"updated_date={date}"
        d.mkdir(parents=True, exist_ok=True)
        with gzip.open(d / f"part_{part}.gz", "wt") as f:
            for i in ids:
                f.write(json.dumps({"id": i, "type": "article", "publication_year": 2020, "primary_location": {"source": {"id": "S", "type": "journal"}}, "counts_by_year": [{"year": 2021, "cited_by_count": 4}]}) + "\n")

    put("2024-01-01", 0, "W1", "W2")
    lines = SW.read_snapshot(spark, f"{tmp_path}/raw", partitions=2)
    assert {(r.id, r.updated_date) for r in SW.parse_snapshot(lines).collect()} == {("W1", "2024-01-01"), ("W2", "2024-01-01")}
    run = lambda: extract_new_files(spark, f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/cp", 2018, 2025, [2021])
    run()
    run()
    put("2024-01-02", 0, "W2", "W3")
    run()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((r.work_id, str(r.updated_date), r.citations_2021) for r in got) == [("W1", "2024-01-01", 4), ("W2", "2024-01-01", 4), ("W3", "2024-01-02", 4)]


def test_ledger(spark, tmp_path, monkeypatch):
    """Nothing read twice, dates without works remembered, a failed run without a trace, known ids left out with a filter of any size."""
    import gzip
    import json

    from scholmill.streaming import ledger as L

    def put(date, part, *ids, kind="article"):
        d = tmp_path / "raw" / f"updated_date={date}"
        d.mkdir(parents=True, exist_ok=True)
        with gzip.open(d / f"part_{part}.gz", "wt") as f:
            f.writelines(json.dumps({"id": i, "type": kind, "publication_year": 2020, "primary_location": {"source": {"id": "S", "type": "journal"}}, "counts_by_year": [{"year": 2021, "cited_by_count": 4}]}) + "\n" for i in ids)

    raw, store = f"{tmp_path}/raw", f"{tmp_path}/store"
    run = lambda **kw: L.run(spark, raw, store, 2018, 2025, [2021], **kw)
    put("2024-01-01", 0, "W1", "W2")
    put("2024-01-01", 1, "B", kind="book")
    put("2024-01-02", 0, "B2", kind="book")
    first = run(expected=10)
    assert first["n_lines"] == 4 and L.read_store(spark, store).count() == 2
    assert sorted((r.updated_date, r.file_path[-9:], r.n_works) for r in L.read_ledger(spark, store).collect()) == [("2024-01-01", "part_0.gz", 2), ("2024-01-01", "part_1.gz", 0), ("2024-01-02", "part_0.gz", 0)]
    assert run(expected=10)["run"] is None and L.unread(spark, raw, store).count() == 0
    put("2024-01-02", 7, "W9")
    assert L.unread(spark, raw, store).count() == 0 and [r.file_path[-9:] for r in L.unread(spark, raw, store, by="file").collect()] == ["part_7.gz"]
    put("2024-01-03", 0, "W2", *(f"X{i}" for i in range(500)))
    with monkeypatch.context() as m:
        m.setattr(L.B, "bloom", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(expected=10)
    assert L.read_store(spark, store).count() == 2
    second = run(expected=10)
    assert second["n_lines"] == 501 and L.read_store(spark, store).count() == 502
    put("2024-01-04", 0, "W1", "X7", "Y")
    with monkeypatch.context() as m:
        m.setattr(L.B, "BROADCAST", 0)
        assert run(expected=10)["n_lines"] == 3
    got = L.read_store(spark, store)
    assert got.count() == 503 and got.select("work_id").distinct().count() == 503 and {r[0] for r in got.groupBy("run").count().select("count").collect()} == {2, 500, 1}
    with pytest.raises(ValueError):
        L.unread(spark, raw, store, by="month")


def test_bloom(spark):
    from scholmill.operators import bloom as B

    ids = spark.range(3000).select(F.concat(F.lit("W"), "id").alias("work_id"))
    for blocks in (1, B.blocks_for(3000), 50):
        whole, parts = B.bloom(ids, "work_id", blocks), B.merged(B.bloom(ids.filter("work_id < 'W2'"), "work_id", blocks).unionByName(B.bloom(ids.filter("work_id >= 'W2'"), "work_id", blocks)))
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
        asked = spark.range(2000, 6000).select(F.concat(F.lit("W"), "id").alias("work_id")).unionByName(spark.createDataFrame([(None,)], "work_id string"))
        rows = {r.work_id: r.maybe for r in B.with_maybe(asked, "work_id", whole, blocks).collect()}
        assert all(rows[f"W{i}"] for i in range(2000, 3000)) and not rows[None] and sum(rows.values()) < (2000 if blocks == 1 else 1200)
    with pytest.raises(ValueError):
        B.with_maybe(ids, "work_id", whole, B.BROADCAST)


def test_works_of_several_schemas(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "work_id string, citations_2020 long").write.parquet(f"{tmp_path}/w/x")
    spark.createDataFrame([("b", 1.5, 2)], "work_id string, citations_2020 double, citations_2021 long").write.parquet(f"{tmp_path}/w/y")
    (tmp_path / "w" / "empty.parquet").touch()
    got = SW.read_works(spark, f"{tmp_path}/w")
    assert dict(got.dtypes)["citations_2020"] == "double" and sorted(map(tuple, got.collect())) == [("a", 1.0, None), ("b", 1.5, 2)]
    # a folder of two schemas, files beside a folder, an empty and a hidden file in a folder that is read whole, folders by date
    spark.createDataFrame([("c", 3.5)], "work_id string, citations_2020 double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/w/x")
    spark.createDataFrame([("d", 4)], "work_id string, citations_2020 int").coalesce(1).write.parquet(f"{tmp_path}/w/y/z")
    (tmp_path / "w" / "y" / "z" / "empty.parquet").touch()
    (tmp_path / "w" / "y" / "z" / "_note.parquet").write_text("no Parquet")
    spark.createDataFrame([("e", 5, "2024-01-01"), ("f", 6, "2024-01-02")], "work_id string, citations_2020 long, updated_date string").write.partitionBy("updated_date").parquet(f"{tmp_path}/dates")
    got = SW.read_works(spark, f"{tmp_path}/w")
    assert sorted(map(tuple, got.select("work_id", "citations_2020").collect())) == [("a", 1.0), ("b", 1.5), ("c", 3.5), ("d", 4.0)]
    dates = SW.read_works(spark, f"{tmp_path}/dates")
    assert sorted((r.work_id, str(r.updated_date)) for r in dates.collect()) == [("e", "2024-01-01"), ("f", "2024-01-02")]
    plan = dates.filter("citations_2020 > 5").select("work_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(citations_2020), GreaterThan(citations_2020,5)]" in plan and plan.count("FileScan") == 1
    with pytest.raises(ValueError):
        (tmp_path / "none").mkdir()
        SW.read_works(spark, f"{tmp_path}/none")


DOCS = "doc_idx long, collection string, pid_v2 string, doi string, doi_with_lang map<string,string>, titles array<string>, publication_year int, journal_issns array<string>, journal_title string, document_type string"


def doc(i, pid="P", doi="", titles=("averylongtitleofanarticle",), year=2020, issns=("I",), journal="J", langs=None, collection="c"):
    return (i, collection, pid, doi, langs or {}, list(titles), year, list(issns), journal, "article")


@pytest.mark.parametrize(
    ("a", "b", "rules", "same"),
    [
        (doc(0, "A", "d"), doc(1, "B", "d", year=1), ("doi",), True),
        (doc(0, "A", "d"), doc(1, "B", "d", titles=("other",)), ("doi",), False),
        (doc(0, "A", "", langs={"en": "d"}), doc(1, "B", "d"), ("doi",), True),
        (doc(0), doc(1, issns=("K",)), ("pid",), True),
        (doc(0, journal=""), doc(1, issns=("K",), journal=""), ("pid",), False),
        (doc(0), doc(1, year=2021), ("pid",), False),
        (doc(0, year=None), doc(1, year=None), ("pid",), True),
        (doc(0, "A"), doc(1, "B"), ("title",), True),
        (doc(0, "A", titles=("short",)), doc(1, "B", titles=("short",)), ("title",), False),
        (doc(0, "A"), doc(1, "B"), ("doi", "pid"), False),
        (doc(0, "A", "d"), doc(1, "B", "d"), (), False),
    ],
)
def test_rules(spark, a, b, rules, same):
    got = A.article_of(spark.createDataFrame([a, b], DOCS), rules).collect()
    assert (len({r.article_idx for r in got}) == 1) == same


def test_consolidation(spark):
    rows = [doc(0, "P2", "", langs={"en": "x", "es": "e0"}, collection="b"), doc(1, "P1", "", langs={"en": "y"}, year=2019, titles=("averylongtitleofanarticle", "zz"), collection="a"), doc(2, "P3", titles=("alone",), langs={"en": "q"})]
    rows[1] = (*rows[1][:6], 2020, *rows[1][7:])
    got = {r.article_idx: r for r in A.resolve_articles(spark.createDataFrame(rows, DOCS)).collect()}
    m = got[0]
    assert (m.collection, m.pid_v2, m.doi_with_lang, m.doi, m.titles, m.n_docs) == (["a", "b"], ["P1", "P2"], {"en": "y", "es": "e0"}, "e0", ["averylongtitleofanarticle", "zz"], 2)
    assert got[2].doi == "" and got[2].collection == ["c"]
    audit = A.merge_audit(spark.createDataFrame([doc(0, doi="d"), doc(1, doi="d", titles=("no",)), doc(2, doi="d")], DOCS)).collect()
    assert sorted((r.left_idx, r.right_idx, r.merged) for r in audit) == [(0, 1, False), (0, 2, True), (1, 2, False)]


def test_article_docs(spark, tmp_path):
    import json

    record = {"collection_acronym": "scl", "publisher_id": "P", "publication_year": "2020", "doi": "10/A", "doi_and_lang": [["en", "x"]], "document_type": " a ", "original_title": "Ação", "translated_titles": {"en": "Action"}, "journal": {"title": " J ", "any_issn": "2", "print_issn": " 1 "}}
    record["doi_and_lang"] = [{"lang": "en", "doi": "doi:10/B"}, {"lang": "en", "doi": "10/C"}, {"lang": "pt", "doi": ""}]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(r) for r in (record, record | {"publication_year": "1999"}, record | {"doi": None, "doi_and_lang": []}, record | {"publication_year": None})))
    got = A.article_docs(SA.read_records(spark, f"{tmp_path}/r.json"), 2018, 2025).collect()
    assert len(got) == 1
    d = got[0]
    assert (d.doi, d.doi_with_lang, d.titles, d.journal_issns, d.journal_title, d.document_type) == ("10/a", {"en": "10/c"}, ["acao", "action"], ["1", "2"], "J", "a")
    SA.write_json(A.resolve_articles(spark.createDataFrame([doc(0)], DOCS)), f"{tmp_path}/resolved")
    assert SA.read_resolved(spark, f"{tmp_path}/resolved").first().collection == ["c"]


def test_numbers_by_file_and_line(spark, tmp_path):
    """Files of different sizes in several blocks: numbers follow names and lines, not the tasks."""
    from scholmill.sources.order import numbered, placed

    want = []
    for name, n in (("a", 3), ("b", 4000), ("c", 50)):
        lines = [f"{name}{i:05d}" for i in range(n)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines))
        want += lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = numbered(placed(spark.read.text(str(tmp_path))), "n")
        assert got.rdd.getNumPartitions() > 1 and [r.value for r in got.orderBy("n").collect()] == want and sorted(r.n for r in got.collect()) == list(range(len(want)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.txt").touch()
    assert numbered(placed(spark.read.text(f"{tmp_path}/none")), "n").count() == 0


def test_audit_in_chunks(spark):
    import random

    rnd = random.Random(4)
    docs = [doc(i, doi=f"d{rnd.randrange(3) if i else 9}", langs={"en": f"d{rnd.randrange(3)}"}, titles=rnd.sample(("a", "b", "c"), rnd.randrange(3))) for i in range(60)]
    df = spark.createDataFrame(docs, DOCS)
    want = set()
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            want |= {(d, a[0], b[0], bool(set(a[5]) & set(b[5]))) for d in {a[3], *a[4].values()} & {b[3], *b[4].values()}}
    for chunk in (1, 7, 1000):
        got = [(r.doi, r.left_idx, r.right_idx, r.merged) for r in A.expand_audit(A.audit_members(df), chunk).collect()]
        assert len(got) == len(want) and set(got) == want
    assert A.audit_classes(df).agg(F.sum("n_docs")).first()[0] == A.audit_members(df).count()


def test_vocabulary(spark, tmp_path):
    (tmp_path / "domain.txt").write_text('"A"\n\n "B b" \n')
    got = SA.category_vocabulary(spark, str(tmp_path), "domain")
    assert [r[0] for r in got.collect()] == ["A", "B b"] and SA.category_vocabulary(spark, str(tmp_path), "nope").count() == 0
    used = G.category_coverage(got, spark.createDataFrame([("A",)], "category_id string")).collect()
    assert sorted(map(tuple, used)) == [("A", 1), ("B b", 0)]


def test_integrate(spark, works):
    articles = spark.createDataFrame([(0, "10/a", {"pt": "10/b"}, ["S1"], ["c"], 2020), (1, "10/none", {}, ["S0002"], ["c"], 2020), (2, "10/c", {}, ["S3"], ["c"], 2020)], "article_idx long, doi string, doi_with_lang map<string,string>, pid_v2 array<string>, collection array<string>, publication_year int")
    out = {r.work_id: r for r in G.integrate(articles, works.drop("is_merged", "oa_individual_works"), 2020, 2020).collect()}
    assert set(out) == {"W1", "W3", "W4", "W5", "scielo:S0002"}
    w = out["W1"]
    assert w.citations_total == 30 and w.is_merged and w.all_work_ids == ["W1", "W2"] and w.scielo_pid_v2 == ["S1"] and '"language":"pt"' in w.oa_individual_works
    assert not out["W3"].is_merged and out["W3"].scielo_collection == ["c"] and out["W4"].all_work_ids == ["W4"] and out["W4"].citations_total == 0
    assert out["W5"].scielo_pid_v2 is None and out["scielo:S0002"].citations_total == 0 and out["scielo:S0002"].all_work_ids == []
    first = G.merge_works(G.match_articles(articles, works, 2020, 2020), works.drop("is_merged", "oa_individual_works").withColumn("o", -F.substring("work_id", 2, 1).cast("int")), "first_scanned", ("o",))
    assert {r.work_id for r in first.collect()} == {"W2", "W3", "W4", "W5"}
    cover = G.coverage(G.match_articles(articles, works, 2020, 2020), ("publication_year",)).first()
    assert (cover.n_articles, cover.n_matched) == (3, 2)
    with pytest.raises(ValueError):
        G.merge_works(articles, works, "other")


def test_stored_by_doi(spark, works, tmp_path):
    flat = works.drop("is_merged", "oa_individual_works")
    articles = spark.createDataFrame([(0, "10/a", {"pt": "10/b"}, ["S1"], ["c"], 2020), (1, "10/none", {}, ["S0002"], ["c"], 2020), (2, "10/c", {}, ["S3"], ["c"], 2020)], "article_idx long, doi string, doi_with_lang map<string,string>, pid_v2 array<string>, collection array<string>, publication_year int")
    more = flat.unionByName(flat.filter("work_id = 'W4'").withColumns({"work_id": F.lit(None).cast("string"), "doi": F.lit(" ")})).unionByName(flat.filter("work_id = 'W1'").withColumns({"work_id": F.lit("W9"), "publication_year": F.lit(2021)}))
    stored = G.store_by_doi(more, "stored_by_doi", f"{tmp_path}/stored", 4)
    for years in ((2020, 2020), (2020, 2021)):
        plain, by_doi = (sorted(map(str, G.integrate(articles, w, *years).drop("oa_individual_works").collect())) for w in (more, stored))
        assert plain == by_doi and len(plain) >= 6
    with pytest.raises(ValueError):
        G.store_by_doi(flat.unionByName(flat), "twice", f"{tmp_path}/twice", 4)
    with pytest.raises(ValueError):
        G.merge_works(G.match_articles(articles, stored, 2020, 2020), stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        # above every join with the table's rows, its side is sorted or filtered, but not exchanged
        plan = G.integrate(articles, stored, 2020, 2020)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [k for k, line in enumerate(plan) if "stored_by_doi" in line and "FileScan" in line]
    assert scans and all("Bucketed: true" in plan[k] for k in scans)
    for k in scans:
        depth = len(plan[k]) - len(plan[k].lstrip(" :+-"))
        while "SortMergeJoin" not in plan[k]:
            assert "Exchange" not in plan[k]
            k = max(j for j in range(k) if len(plan[j]) - len(plan[j].lstrip(" :+-")) < depth)
            depth = len(plan[k]) - len(plan[k].lstrip(" :+-"))
    spark.sql("DROP TABLE stored_by_doi")


def test_counts_without_a_lambda_a_year(spark):
    """Of several counts for a year the last holds, a window sums all; the plan interprets lambdas for the windows and the null check only."""
    years = [0, 1999, 2000, 2001, 2003]
    counts = [[(2000, 1), (2000, 5), (2001, 2), (2003, 7), (2006, 9)], None, [], [(None, 3), (0, 4), (1999, 6)], [(2005, 8), (2000, None), (2003, 1), (2003, 2)]]
    raw = spark.createDataFrame([(str(i), "article", False, 2000, [({"id": f"J{k}", "type": t, "issn_l": None, "is_oa": True},) for k, t in enumerate(("repository", "journal", "journal"))] , c) for i, c in enumerate(counts)],
                                "id string, type string, is_xpac boolean, publication_year int, locations array<struct<source: struct<id: string, type: string, issn_l: string, is_oa: boolean>>>, counts_by_year array<struct<year: int, cited_by_count: long>>")
    raw = spark.read.schema(SW.RAW_SCHEMA).json(raw.toJSON())
    flat = E.project(E.accepted(raw, 1, 9999), years)
    got = {int(r.work_id): r for r in flat.collect()}
    for i, c in enumerate(counts):
        held = [(y, n) for y, n in c or [] if y]
        assert [got[i][f"citations_{y}"] for y in years] == [([n for z, n in held if z == y] or [None])[-1] for y in years] and got[i].journal_id == "J1"
        assert [got[i][f"citations_window_{w}y"] for w in (2, 3, 5)] == [sum(n for z, n in held if 2000 < z <= 2000 + w) for w in (2, 3, 5)]
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lambdafunction(") <= 3, plan.count("lambdafunction(")


def test_snapshot_of_several_files_a_date(spark):
    """A date of the snapshot is no single gzip file, which one task would have to read, and all versions of a work are in one file of a date."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        store, _ = PQ._two_runs(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lines = spark.read.text(store.removesuffix("store") + "raw").select("updated_date", F.get_json_object("value", "$.id").alias("id"), F.col("_metadata.file_path").alias("f"))
    assert all(r.n > 1 for r in lines.groupBy("updated_date").agg(F.count_distinct("f").alias("n")).filter("updated_date > '2024-01-02'").collect())
    assert lines.filter("updated_date > '2024-01-02'").groupBy("updated_date", "id").agg(F.count_distinct("f").alias("n")).filter("n > 1").isEmpty()


def test_audit_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Few rows make many pairs, so tasks follow pairs and not bytes."""
    docs = spark.range(400).selectExpr("id AS doc_idx", "array(cast(id % 3 AS string)) AS titles", "concat('d', id % 8) AS doi", "cast(NULL AS map<string,string>) AS doi_with_lang")
    monkeypatch.setattr(A, "PAIRS_A_TASK", 250, raising=False)
    pairs = A.expand_audit(A.audit_members(docs), chunk=5)
    assert pairs.count() == 8 * 50 * 49 // 2
    assert pairs.groupBy(F.spark_partition_id()).count().count() > 20


def test_links_are_made_by_all_tasks(spark, tmp_path):
    """A small graph is kept in few partitions, but not what its links are made from."""

    def note(batches):
        at = TaskContext.get()
        (tmp_path / f"{at.stageId()}-{at.partitionId()}-{at.taskAttemptId()}").touch()
        yield from batches

    links = spark.range(0, 1000, 1, 8).selectExpr("id AS a", "id - id % 10 AS b").mapInArrow(note, "a long, b long")
    assert {(r.node, r.label) for r in components(links).collect()} == {(i, i - i % 10) for i in range(1000)}
    stages = Counter(f.name.split("-")[0] for f in tmp_path.iterdir())
    parts = {s: len({f.name.split("-")[1] for f in tmp_path.iterdir() if f.name.startswith(s + "-")}) for s in stages}
    assert set(parts.values()) == {8}, parts


def test_titles_are_folded_a_few_at_a_time():
    """A batch of whole texts is not turned into objects at once."""
    texts = pa.array([f"Éà  {k} " + "ﬁ" * 2000 for k in range(4000)] + [None])
    folded = N._folded.func
    tracemalloc.start()
    got = folded(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == [f"ea{k}" + "fi" * 2000 for k in range(4000)] + [None]
    assert peak < 4 << 20, peak


def test_journals_move_a_work_once(spark, works):
    """Works move by journal and year, before there is a row for each level, and nothing moves by category until journals are counted; no text makes the grouping sort."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for df in (C.journal_multilingual(works), C.journal_sizes(works), C.journal_metrics(works, C._small(cut(C.cohort_thresholds_bracketed(works))))):
        p = plan(df)
        assert p.count("hashpartitioning(journal_id") == 1 and "hashpartitioning(category_level" not in p and "SortAggregate" not in p, p
    several = works.unionByName(works.withColumn("journal_issn_l", F.lit("A9"))).unionByName(works.withColumn("journal_issn_l", F.lit(None).cast("string")))
    found = {(r.publication_year, r.journal_id): (r.journal_issn, r.journal_publications_count) for r in C.journal_metrics(several, C.cohort_thresholds(several), ("field",)).collect()}
    assert found == {(2020, "S1"): ("A9", 6), (2020, "S2"): ("A9", 3), (2021, "S1"): ("A9", 3)}
    assert {r.journal_issn for r in C.journal_metrics(works.withColumn("journal_issn_l", F.lit(None).cast("string")), C.cohort_thresholds(works)).collect()} == {None}


def test_only_columns_asked_for(spark, works, monkeypatch):
    """Columns asked for are those of the whole table, and thresholds and sizes that none of them needs are not made."""
    whole = I.build_indicators(works)
    asked = [*C.COHORT, "journal_id", "journal_impact_cohort_window_3y", "journal_issn"]
    key = lambda r: tuple(map(str, r))
    for columns in (asked, [*asked, "top_10pct_window_3y_publications_share_pct"], [*asked, "category_publications_median"], ["citations_window_2y_works", "journal_id"]):
        got = I.build_indicators(works, columns=columns)
        assert sorted(got.columns) == sorted(columns) and sorted(map(key, got.collect())) == sorted(map(key, whole.select(*got.columns).collect()))
    with pytest.raises(ValueError):
        I.build_indicators(works, columns=["none"])
    monkeypatch.setattr(C, "publication_stats_bracketed", lambda journals: pytest.fail("sizes are not asked for"))
    monkeypatch.setattr(C.Q, "_picked", lambda *a: pytest.fail("thresholds are not asked for"))
    assert I.build_indicators(works, columns=asked).count() == whole.count()


def test_cohorts_are_counted_level_by_level(spark, works, tmp_path, monkeypatch):
    """Cohorts of written works are counted without a row for each level, each level from its own column; journals meet cohorts again only for columns of theirs."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    odd = works.unionByName(works.withColumn("topic", F.lit(None).cast("string"))).unionByName(works.withColumn("publication_year", F.lit(None).cast("int")))
    odd.write.parquet(f"{tmp_path}/works")
    odd = spark.read.parquet(f"{tmp_path}/works")
    for ranks in ((50, 90), ()):
        made = [sorted(map(tuple, C.settled_cohorts(rows, (2,), ranks, "exact", True).collect())) for rows in (C.cohort_rows(odd, years=[2020, 2021]), C.level_rows(odd, years=[2020, 2021]))]
        assert made[0] and made[0] == made[1]
    for level, rows in zip(C.LEVELS, C.level_rows(odd)):
        p = plan(rows.groupBy(*C.COHORT).count())
        assert "Expand" not in p and f"ReadSchema: struct<{level}:string,publication_year:int>" in p.replace(f"publication_year:int,{level}:string", f"{level}:string,publication_year:int"), p
    monkeypatch.setattr(C, "cohort_rows", lambda *a: pytest.fail("a row for each level is made"))
    share = I.build_indicators(works, columns=[*C.COHORT, "journal_id", "top_50pct_all_time_publications_share_pct"])
    assert plan(share).count("Join") == 1 and plan(I.build_indicators(works, columns=["journal_id", "journal_impact_cohort"])).count("Join") == 1


def test_reports_make_no_cohorts(spark, works, monkeypatch):
    """Cohorts and metadata are not made where no column needs them."""
    meta = spark.createDataFrame([("S1", 2020, "One")], "journal_id string, publication_year int, journal_title string")
    want = I.build_indicators(works, meta).select("journal_id", "journal_issn").collect()
    monkeypatch.setattr(C, "settled_cohorts", lambda *a: pytest.fail("cohorts are not asked for"))
    got = I.build_indicators(works, meta, columns=["journal_id", "journal_issn"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2  # ISSNs' numbers, there and back
    assert {r.journal_title for r in I.build_indicators(works, meta, columns=["journal_title", "publication_year"]).collect()} >= {"One"}


def test_metadata_sorts_no_journals(spark, works):
    """Journals that lie by journal and year meet large metadata without a sort and without moving again."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        meta = spark.createDataFrame([("S1", 2020, "One")], "journal_id string, publication_year int, journal_title string")
        out = I.with_metadata(C.journal_sizes(works), meta)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and plan.count("hashpartitioning(journal_id") == 2, plan
        assert {(r.journal_id, r.publication_year, r.journal_title) for r in out.collect()} >= {("S1", 2020, "One"), ("S2", 2020, "S2")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_weighted_ranks(spark):
    """Values counted before have the ranks of the rows that they stand for, at either side of a bracket."""
    values = [(1, 3, 2), (1, 700_000, 3), (1, 700_001, 1), (2, -5, 1)]
    df = spark.createDataFrame(values, "g int, x long, times long")
    ranks = [*Q.middle("x"), Q.percentile("p", "x", 90)]
    groups = df.groupBy("g").agg(F.sum("times").alias("n"))
    assert {tuple(r) for r in Q.settle(groups, df, ["g"], ranks, "times").collect()} == {(1, 6, 700_000, 700_000, 700_001), (2, 1, -5, -5, -5)}
    sizes = spark.createDataFrame([("d", "c", 2020, n) for n in (1, 1, 2, 9)], "category_level string, category_id string, publication_year int, journal_publications_count long")
    for f in (C.publication_stats, C.publication_stats_bracketed):
        assert tuple(f(sizes).first())[3:] == (3.25, 1.5)


def test_merge_reads_works_and_matches_once(spark, works):
    """The merged table is planned from copies written once: neither works nor articles are made again for the match, the merge and what is left."""
    articles = spark.createDataFrame([(1, "10/a", ["P"]), (2, "10/z", ["Q"])], "article_idx long, doi string, pid_v2 array<string>")
    out = G.integrate(articles, works.drop("is_merged", "oa_individual_works"), 2000, 2030)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan and "LocalTableScan" not in plan, plan
    assert sorted(r.work_id for r in out.collect()) == ["W1", "W2", "W3", "W4", "W5", "scielo:Q"]


def test_strip_takes_all_white_space(spark):
    """What stands at the ends and is white space to Unicode, as a regular expression finds it, for every character of 16 bits."""
    chars = spark.createDataFrame([(f" \t{c}a {c}b{c}\n",) for c in map(chr, range(1, 0x10000)) if not "\ud800" <= c <= "\udfff"], "x string")
    out = chars.select(N.strip("x").alias("got"), F.regexp_replace("x", r"(?U)^\s+|\s+$", "").alias("want"))
    assert out.filter("got <> want OR got IS NULL").count() == 0 and out.filter("startswith(got, 'a')").count() == 25 + 1  # the letter a too


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def test_merge_leaves_no_shuffles_and_moves_works_of_articles_only(spark, works):
    """Once the merge is planned its shuffle files are gone; in the plan works without article don't move, those of one move once, and neither has columns that nobody asks for."""
    articles = spark.createDataFrame([(1, "10/a", ["P"]), (2, "10/z", ["Q"])], "article_idx long, doi string, pid_v2 array<string>")
    asked = ["work_id", "citations_total", "domain", "scielo_pid_v2", "all_work_ids"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        before = _shuffle_files(spark)
        out = G.integrate(articles, works.drop("is_merged", "oa_individual_works"), 2000, 2030, columns=asked)
        for _ in range(100):  # they are removed in the background
            if not (left := _shuffle_files(spark) - before):
                break
            time.sleep(0.1)
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not left and out.columns == asked
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    exchanges = {}
    for k, line in enumerate(plan):
        if "FileScan" in line and "work_id" in line:
            assert "topic" not in line and "language" not in line
            depth, above = indent(line), 0
            for up in reversed(plan[:k]):
                if indent(up) < depth:
                    depth, above = indent(up), above + ("Exchange" in up)
            exchanges["IsNull(_article)" in line] = above
    assert exchanges == {True: 0, False: 1}, plan
    assert sorted((r.work_id, r.citations_total, r.domain, r.scielo_pid_v2, r.all_work_ids) for r in out.filter("work_id IN ('W1', 'scielo:Q')").collect()) == [("W1", 20, "d", ["P"], ["W1"]), ("scielo:Q", 0, None, ["Q"], [])]


@pytest.mark.parametrize("repeated", [False, True])
def test_integrate_against_matches_and_merge(spark, works, repeated):
    """The table equals that of ``match_articles``, ``merge_works`` and ``unmatched_articles``: ids once or repeated, without id or DOI, of other years, DOIs of several articles, articles twice."""
    rng = random.Random(5)
    pick = lambda *v: rng.choice(v)
    names, rows = [c for c in works.columns if c not in ("is_merged", "oa_individual_works")], []
    for k in range(300):
        if not (repeated and k % 3 == 1):  # else all but the DOI is that of the row before
            row = {c: pick(None, 0, 1, 7, 1000) for c in names if c.startswith("citations_")} | {c: pick(None, "", "x", "y") for c in names if c in (*C.LEVELS, "language", "journal_id", "journal_issn_l")}
            row |= {"publication_year": pick(None, 2019, 2020, 2020, 2020), "is_journal_oa": pick(None, 0, 1), "work_id": None if k % 29 == 0 else f"W{k}"}
        rows.append(row | {"doi": pick(None, "", " ", f" W{k}", *[f"https://doi.org/10/{'Aa'[n % 2]}{n}" for n in range(60)] * 2)})
    all_works = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], works.select(*names).schema)
    made = [(n % 40 or None, pick(None, "", f" W{n}", f"10/a{n}", f"10/a{n % 30}"), {"pt": f"10/a{n + 5}"}, [f"P{n % 40}"], ["c"], 2000) for n in range(45)]
    articles = spark.createDataFrame(made, "article_idx long, doi string, doi_with_lang map<string,string>, pid_v2 array<string>, collection array<string>, publication_year int")
    assert repeated == (all_works.filter("work_id IS NOT NULL").groupBy("work_id").count().filter("count > 1").count() > 0)
    # of rows with one id, which one is kept, and so its DOI, is open
    shown = lambda df: sorted(map(str, df.withColumn("doi", F.when(F.lit(not repeated) | F.col("oa_individual_works").isNull(), F.col("doi"))).collect()))
    matched = G.match_articles(articles, all_works, 2020, 2020, [2024])
    merged = G.merge_works(matched, all_works)
    want = cut(merged.unionByName(G.unmatched_articles(matched, merged)))
    got = G.integrate(articles, all_works, 2020, 2020, [2024])
    assert got.dtypes == want.dtypes and shown(got) == shown(want)
    assert all(want.filter(c).count() > 3 for c in ("is_merged", "scielo_pid_v2 IS NULL", "startswith(work_id, 'scielo:')"))
    few = ["is_merged", "work_id", "topic"]
    assert sorted(map(str, G.integrate(articles, all_works, 2020, 2020, columns=few).collect())) == sorted(map(str, want.select(*few).collect()))
