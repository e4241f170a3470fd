import pytest
from pyspark.sql import functions as F

from sitegrain.operators import aggregate as ag
from sitegrain.operators import dedupe as dd
from sitegrain.operators import joins as jo
from sitegrain.operators import ordered as od
from sitegrain.operators import reshape as rs
from sitegrain.sources import files, sinks
from sitegrain.streaming import resume as st


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def master(spark):
    return spark.createDataFrame([(0, "a", "1"), (1, "b", None), (2, "a", "3"), (3, None, "4")], "ord long, key string, v string")


@pytest.fixture(scope="module")
def new(spark):
    return spark.createDataFrame([(0, "a", "x"), (1, "a", None), (2, "c", "z"), (3, None, "n")], "ord long, key string, v string")


def test_todo(master, new):
    assert rows(jo.todo(master, new.where("key is not null"), "key"), "ord") == [(1,), (3,)]
    assert rows(jo.todo(master, new, "key", limit=1), "ord") == [(1,)] and jo.todo(master.where("false"), new, "key").count() == 0


def test_replacements(master, new):
    assert rows(jo.replace_every(master, new, "key"), "key", "v", "part", "place") == sorted([("a", None, 0, 0), ("b", None, 0, 1), ("a", None, 0, 2), (None, "4", 0, 3), ("c", "z", 1, 2)], key=repr)
    assert rows(jo.replace_first(master, new.where("v is not null"), "key"), "ord", "v") == sorted([(0, "x"), (1, None), (2, "3"), (3, "4")], key=repr)
    assert rows(jo.replace_partitions(master, new.where("key = 'a'"), F.col("key")), "key", "v", "part") == sorted([("b", None, 0), (None, "4", 0), ("a", "x", 1), ("a", None, 1)], key=repr)
    with pytest.raises(ValueError, match="columns differ"):
        jo.replace_every(master, new.drop("v"), "key")


def test_numbers(spark, master):
    shuffled = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 37 % 5000 * 3).alias("ord"))
    got = rows(jo.numbered(shuffled), "ord", "request_id")
    assert got == sorted(((3 * i, i + 1) for i in range(5000)), key=repr)
    assert jo.numbered(shuffled.where("false")).count() == 0
    assert rows(jo.numbered(master, per=["key"]), "ord", "request_id") == [(0, 1), (1, 1), (2, 2), (3, 1)]


def test_matches(spark):
    left = spark.createDataFrame([(1, "u", "x"), (2, "w", "x"), (3, None, "y")], "ord long, by string, city string")
    right = spark.createDataFrame([("u", 9, "x"), ("u", 8, "x"), ("u", 7, "z"), (None, 6, "y")], "by string, c_ord long, c_city string")
    assert rows(jo.best_match(left, right, "by", [F.col("city") == F.col("c_city")]), "ord", "c_ord") == [(1, 8), (2, None), (3, None)]
    assert rows(spark.createDataFrame([("abca", "cad")], "a string, b string").select(jo.shared_letters(F.col("a"), F.col("b")).alias("n")), "n") == [(2,)]


def test_lookup(spark, master):
    names = spark.createDataFrame([("a", "A"), ("b", None)], "key string, name string")
    assert rows(jo.lookup(master, names, "key", {"name": "?"}), "ord", "name") == [(0, "A"), (1, "?"), (2, "A"), (3, "?")]


PLACE = "ord long, domain string, address_street string, address_city string, address_zip string, address_state string, phone string, location_name string"


def test_dedupes(spark):
    data = [(0, "d", "100 Main St", "C", "12345", "TX", "", ""), (1, "d", "100 main street", "c", "", "TX", "1", "n"), (2, "d", "102 Main St", "C", "12345", "TX", "", ""), (3, "d", "", "C", "", "TX", "", ""), (4, "d", None, None, "99999", None, None, None), (5, "d", "", "", "", "", "", ""), (6, "e", "", "C", "", "", "", ""), (7, "d", "100 Main Street", "C", "12345", "TX", "", "")]
    frame = spark.createDataFrame(data, PLACE)
    assert rows(dd.most_complete(frame, dd.street_key(), ["address_zip", "phone", "location_name"]).where("n_rows > 1"), "ord", "first_ord", "n_rows") == [(1, 0, 3), (4, 4, 2)]
    assert rows(dd.dedupe_places(frame), "ord") == [(0,), (1,), (2,), (4,), (6,)]
    assert rows(dd.dedupe_places(frame, keep_empty=True), "ord") == [(0,), (1,), (2,), (4,), (5,), (6,)]
    assert rows(dd.dedupe_unless_blank(frame, ["address_street", "address_city", "address_zip"]), "ord") == [(0,), (1,), (2,), (3,), (4,), (5,), (7,)]
    assert dd.dedupe_places(frame.where("false")).count() == 0


def test_first_success(spark):
    data = [("u", 1, False), ("u", 2, True), ("u", 3, True), ("w", 2, False), ("w", 1, False)]
    frame = spark.createDataFrame(data, "key string, tier long, ok boolean")
    assert rows(dd.first_success(frame, ["key"], F.col("tier"), F.col("ok")), "key", "tier", "succeeded") == [("u", 2, True), ("w", 2, False)]


def test_aggregates(spark):
    frame = spark.createDataFrame([("a", "exact"), ("a", "miss"), ("b", "skip"), ("c", "soft"), ("c", "null_match"), ("a", None)], "f string, match string")
    counts = ag.graded_counts(frame, ["f"])
    assert rows(counts, "f", "hits", "misses", "skips", "scored") == [("a", 1, 1, 0, 2), ("b", 0, 0, 1, 0), ("c", 2, 0, 0, 2)]
    assert rows(counts.select("f", ag.percent(F.col("hits"), F.col("scored")).alias("p")), "f", "p") == [("a", "50%"), ("b", "n/a"), ("c", "100%")]
    assert rows(spark.range(1).select(ag.percent(F.lit(1), F.lit(8)).alias("p")), "p") == [("12%",)]
    assert rows(ag.having_all(frame, "f", "match", ["exact", "miss"]), "f") == [("a",)]
    assert rows(ag.share_of_total(frame, "f"), "f", "n", "share") == [("a", 3, 0.5), ("b", 1, 0.166667), ("c", 2, 0.333333)]
    before, after = (spark.createDataFrame(x, "k string, n long") for x in ([("a", 1), ("b", 2)], [("b", 2), ("c", 3)]))
    assert rows(ag.delta(before, after, "k"), "k", "change", "kind") == [("a", -1, "lost"), ("b", 0, "same"), ("c", 3, "gained")]


def test_ordered(spark):
    frame = spark.createDataFrame([("d", i, k, f, 1.0) for i, (k, f) in enumerate([("hub", 0), ("page", 0), ("page", 0), ("page", 0), ("hub", 2), ("page", 0), ("home", 0), ("page", 0), ("page", 1), ("page", 0), ("page", 0), ("page", 0), ("page", 5)])], "g string, ord long, kind string, found long, cost double")
    assert rows(od.early_stop(frame, ["g"], "kind", "found"), "ord") == sorted(((i,) for i in range(12)), key=repr)
    assert od.early_stop(frame.where("ord < 4"), ["g"], "kind", "found").count() == 4
    assert od.until_cap(frame, ["g"], "cost", 3.0).count() == 3 and od.until_cap(frame, ["g"], "cost", 0.0).count() == 0
    assert rows(od.running_counts(frame, ["g"], {"hits": F.col("found") > 0}, 5), "row_no", "hits") == [(10, 2), (5, 1)]
    assert rows(od.first_k(frame, ["kind"], [F.col("found").desc(), F.col("ord")], 1), "kind", "ord") == [("home", 6), ("hub", 4), ("page", 12)]
    sample = od.sample_per_group(frame, ["g"], "ord", 4)
    assert sample.count() == 4 and rows(sample, "ord") == rows(od.sample_per_group(frame.repartition(3), ["g"], "ord", 4), "ord")
    assert rows(od.with_fallback(frame, ["g"], [F.col("found") > 9, F.col("found") > 1], 2), "ord") == [(12,), (4,)]
    assert rows(od.with_fallback(frame, ["g"], [F.col("found") > 9], 2), "ord") == [(0,), (1,)]


def test_rolling_rate(spark):
    import datetime
    import random

    r = random.Random(4)
    base = datetime.datetime(2024, 1, 1)
    data = [(r.choice(["a", "a", "a", None, "b"]), i, base + datetime.timedelta(seconds=r.randint(0, 400))) for i in range(300)]
    want = {}
    for g in {d[0] for d in data}:
        own = sorted((t, i) for k, i, t in data if k == g)
        for j, (t, i) in enumerate(own):
            lo = max(0, j - 4)
            want[i] = round((j - lo) / max((t - own[lo][0]).total_seconds(), 0.001), 6)
    frame = spark.createDataFrame(data, "g string, ord long, ts timestamp")
    got = {x.ord: x.rate for x in od.rolling_rate(frame, ["g"], "ts", "ord", 5).collect()}
    assert got == pytest.approx(want)
    assert od.rolling_rate(frame.where("false"), ["g"], "ts", "ord").count() == 0


def test_shapes(spark):
    frame = spark.createDataFrame([(1, "x", None, "h", "not_found")], "id long, a__value string, b__value string, a__confidence string, b__confidence string")
    parts = ["value", "confidence"]
    assert rows(rs.widen(rs.nest(frame, ["a", "b"], parts), ["a", "b"], parts), "a__value", "b__value", "b__confidence") == [("x", "", "not_found")]
    assert rows(rs.unpivot(frame, ["id"], ["a", "b"], {"v": "{}__value", "c": "{}__confidence"}), "id", "field", "v") == [(1, "a", "x"), (1, "b", None)]
    assert rows(frame.select(rs.filled_count(frame, ["a__confidence", "b__confidence"]).alias("n")), "n") == [(1,)]


def test_files(spark, tmp_path):
    data = [("a", 'say "hi", you\nthere', None), ("b", " ", ""), (None, "é", "x")]
    sinks.write_csv(spark.createDataFrame(data, "k string, t string, u string"), str(tmp_path / "c"))
    assert rows(files.read_csv(spark, str(tmp_path / "c")), "k", "t", "u") == sorted([("a", 'say "hi", you\nthere', ""), ("b", " ", ""), ("", "é", "x")], key=repr)
    (tmp_path / "l.txt").write_text("domain\n# no\n\n a.test \nb.test\n")
    assert rows(files.read_list(spark, str(tmp_path / "l.txt")), "domain") == [("a.test",), ("b.test",)]
    raw = spark.createDataFrame([(0, "https://WWW.a.test/"), (1, "a.test"), (2, "no dot"), (3, "nodot")], "ord long, domain string")
    assert rows(files.clean_domains(raw), "domain", "ord") == [("a.test", 0)]
    assert rows(spark.range(1).select(files.robots_sitemaps(F.lit("User: x\nSitemap: https://a.test/s.xml\nsitemap:b")).alias("s")), "s") == [(["https://a.test/s.xml", "b"],)]
    letters = spark.range(1, 800).select(sinks.column_letter(F.col("id")).alias("l")).collect()
    assert [letters[i - 1].l for i in (1, 26, 27, 52, 53, 702, 703, 728, 729)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "AAZ", "ABA"]
    assert sinks.markdown_table(spark.createDataFrame([(1, None)], "a long, b string")) == "| a | b |\n|---|---|\n| 1 |  |"


def test_stream_resumes(spark, tmp_path):
    source, output, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "ord long, domain string, status string"
    spark.createDataFrame([(0, "a", "ok"), (1, "b", "retry"), (2, "a", "ok"), (3, None, "ok")], schema).coalesce(1).write.parquet(source)
    keep = F.col("status") != "retry"
    st.append_new(spark.readStream.schema(schema).parquet(source), output, check, "domain", keep)
    assert rows(spark.read.parquet(output), "domain", "ord") == [("a", 0)]
    spark.createDataFrame([(9, "a", "ok"), (10, "b", "ok")], schema).coalesce(1).write.mode("append").parquet(source)
    st.append_new(spark.readStream.schema(schema).parquet(source), output, check, "domain", keep)
    assert rows(spark.read.parquet(output), "domain", "ord") == [("a", 0), ("b", 10)]
