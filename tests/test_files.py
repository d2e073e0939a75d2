import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepanel.plans import workflows
from tidepanel.sinks import stores as sink
from tidepanel.sources import calendar as cal, files, stores as source, weather, utf16
from tidepanel.streaming import ingest

HEADER = ["JOUR", "CODE_STIF_TRNS", "CODE_STIF_RES", "CODE_STIF_ARRET", "LIBELLE_ARRET", "ID", "CATEGORIE_TITRE", "NB_VALD"]


def write(base, year, period, ext, encoding, sep, id_name, lines):
    import pathlib

    path = pathlib.Path(files.build_path(str(base), year, period, ext))
    path.parent.mkdir(parents=True, exist_ok=True)
    header = [id_name if c == "ID" else c for c in HEADER]
    body = "\n".join(sep.join(line) for line in [header, *lines]) + "\n"
    path.write_bytes(body.encode(encoding))
    return str(path)


@pytest.fixture()
def raw(tmp_path):
    line = lambda day, label, ident, count: [day, "1", "2", "3", label, ident, "PASS", count]
    write(tmp_path, 2015, "S1", "csv", "utf-8-sig", ";", "ID_REFA_LDA",
          [line("2015-01-03", "Châtelet", "71", "2 093"), line("2015-01-03", "Châtelet", "71", "Moins de 5")])
    write(tmp_path, 2016, "S1", "txt", "utf-16", "\t", "lda",
          [line("03/01/2016", "Défense", "72", "10"), line("03/01/2016", "Nulle part", "", "5")])
    write(tmp_path, 2017, "T3", "txt", "cp1252", ";", "ID_ZDC", [line("04/01/2017", "Opéra", "73.0", "")])
    return tmp_path


ENTRIES = ((2015, "S1", "csv"), (2016, "S1", "txt"), (2017, "T3", "txt"))


def paths(base):
    return [files.build_path(str(base), *e) for e in ENTRIES]


def test_formats(spark, raw):
    got = {r["path"][-24:]: (r["encoding"], r["separator"]) for r in files.detect_formats(spark, paths(raw)).collect()}
    # Undecodable bytes are replaced, so the first encoding also accepts the third file.
    assert list(dict(sorted(got.items())).values()) == [("utf-8-sig", ";"), ("utf-16", "\t"), ("utf-8-sig", ";")]
    strict = files.detect_formats(spark, paths(raw), strict_decoding=True).collect()
    assert sorted((r["encoding"], r["separator"]) for r in strict) == [("cp1252", ";"), ("utf-16", "\t"), ("utf-8-sig", ";")]


def test_unknown_format_is_an_error(spark, raw):
    bad = raw / "bad.txt"
    bad.write_text("a;b\n1;2\n")
    with pytest.raises(ValueError, match="no valid format"):
        files.require_formats(files.detect_formats(spark, [str(bad)]))
    with pytest.raises(ValueError, match="missing columns"):
        files.read_files(spark, [str(bad)], "utf-8-sig", ";")


def test_facts_with_provenance(spark, raw):
    facts = workflows.load_validations(spark, str(raw), ENTRIES, aggregate=False, strict_decoding=True)
    got = {
        (r["ANNEE"], r["PERIODE"], str(r["JOUR"]), r["ID_LIEU"], r["LIBELLE_ARRET"], r["NB_VALD"])
        for r in facts.collect()
    }
    assert got == {
        ("2015", "S1", "2015-01-03", 71, "Châtelet", 2093.0),
        ("2015", "S1", "2015-01-03", 71, "Châtelet", 3.0),
        ("2016", "S1", "2016-01-03", 72, "Défense", 10.0),
        ("2016", "S1", "2016-01-03", None, "Nulle part", 5.0),
        ("2017", "T3", "2017-01-04", 73, "Opéra", None),
    }


def test_get_data_joins_everything(spark, raw):
    base = raw / "meteo"
    base.mkdir()
    (base / "old.csv").write_text("NUM_POSTE;AAAAMMJJ;RR;TN;TX;TM;FFM;QRR\n75114001;20150103;1.5;1;9;5;3;1\n1;20150103;9;9;9;9;9;1\n")
    (base / "new.csv").write_text("NUM_POSTE;AAAAMMJJ;RR;TN;TX;TM;FFM\n75114001;20160103;;2;8;5;4\n75114001;20140101;1;1;1;1;1\n")
    out = workflows.get_data(
        spark, str(raw), "2015-01-01", None, ENTRIES, ["meteo/old.csv", "meteo/new.csv"]
    ).orderBy("JOUR").collect()
    # Both places carry a hub's label.
    assert [(r["ID_LIEU"], r["NB_VALD_TOTAL"], r["RR"], r["TX"], r["IS_WEEKEND"]) for r in out] == [
        (-1000, 2096.0, 1.5, 9.0, True), (-1001, 10.0, None, 8.0, True)
    ]


def test_missing_files(spark, raw):
    expected = files.manifest(spark, str(raw), ENTRIES + ((2018, "S1", "txt"),))
    present = files.list_files(spark, str(raw))
    assert [r["year"] for r in files.missing_files(expected, present).collect()] == [2018]


def test_calendar(spark):
    days = cal.load_calendar(spark, 2015, 2026, day="d")
    assert days.count() == 12 * 365 + 3
    got = {str(r["d"]): r for r in days.collect()}
    holidays = {d for d, r in got.items() if r["IS_FERIE"]}
    # Published dates: Easter Mondays, Ascension and Whit Monday of two years, fixed days.
    for d in ("2015-04-06", "2015-05-14", "2015-05-25", "2024-04-01", "2024-05-09", "2024-05-20", "2024-07-14"):
        assert d in holidays
    assert sum(d.startswith("2024") for d in holidays) == 11
    assert got["2024-05-10"]["IS_PONT"] and not got["2024-05-09"]["IS_PONT"]
    assert got["2018-12-31"]["IS_PONT"]  # Monday before New Year's Day
    assert not got["2024-08-16"]["IS_VACANCES"]


def test_school_holidays_of_one_zone(spark):
    intervals = spark.createDataFrame(
        [("C", dt.date(2020, 2, 8), dt.date(2020, 2, 10)), ("C", dt.date(2020, 2, 10), dt.date(2020, 2, 11)),
         ("A", dt.date(2020, 3, 1), dt.date(2020, 3, 5))],
        "zone string, start date, end date",
    )
    days = cal.load_calendar(spark, 2020, 2020, intervals, day="d")
    assert sorted(str(r["d"]) for r in days.filter("IS_VACANCES").collect()) == [f"2020-02-{k:02d}" for k in (8, 9, 10, 11)]
    assert days.count() == 366


def test_run_names():
    assert sink.run_name("station", 7, "2022-07-01") == "station_j7_20220701"
    assert sink.run_name("cluster") == "cluster_j0_all"
    assert sink.results_path("/s", "station", 7, None, "baseline") == "/s/station_j7_all_baseline/results"


def test_feature_store_reads_only_the_wanted_buckets(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 50).alias("ID_LIEU"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") / 50).cast("int")).alias("JOUR"))
    path = sink.save_features(df, str(tmp_path / "f"), n_buckets=16)
    got = source.load_features(spark, path, [3, 7])
    assert got.count() == 80 and {r[0] for r in got.select("ID_LIEU").distinct().collect()} == {3, 7}
    assert len(got.inputFiles()) > 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The buckets follow from the stored number of buckets, before any file is opened.
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "n_buckets" in filters and "bucket#" in filters
    assert source.load_features(spark, path, []).count() == 0


def test_log_and_artifacts(spark, tmp_path):
    row = spark.range(1).select(
        F.lit(12.5).alias("mae_pct_median"), F.lit(0.9).alias("r2_median"), F.lit(0).cast("bigint").alias("n_r2_neg"),
        F.lit(3).cast("bigint").alias("n_stations"), F.lit(11.0).alias("mae_pct_j1"),
    )
    for label in ("a", "b"):
        sink.log_experiment(row, str(tmp_path / "log"), label, "", 1.5, horizon=1)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    sample = spark.createDataFrame([(5, 0), (3, 0), (9, 1)], "ID_LIEU bigint, cluster int")
    sink.save_sample(sample, str(tmp_path / "sample"), seed=42)
    assert sorted(r[0] for r in source.load_sample(spark, str(tmp_path / "sample")).collect()) == [3, 5, 9]
    params = spark.createDataFrame([("gamma", 0.1), ("max_depth", 4.0)], "name string, value double")
    sink.save_params(params, str(tmp_path / "params"), n_iter=3)
    assert source.load_params(spark, str(tmp_path / "params")) == {"gamma": 0.1, "max_depth": 4.0}
    with pytest.raises(FileNotFoundError):
        source.load_params(spark, str(tmp_path / "nowhere"))


def test_results_round_trip(spark, tmp_path):
    results = spark.createDataFrame([(1, 2.0, 0.5)], "group_id int, mae double, r2 double")
    path = sink.save_results(results, str(tmp_path), "station", 7, "2015-01-01", "baseline")
    back = source.load_results(
        spark, path, "grain string, horizon string, train_from string, group_id int, mae double, r2 double"
    )
    assert tuple(back.first()) == ("station", "j7", "2015-01-01", 1, 2.0, 0.5)


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    spark.range(10).write.parquet(src)
    schema = "id bigint"
    ingest.ingest_new_files(spark, src, out, ck, schema)
    spark.range(10, 15).write.mode("append").parquet(src)
    ingest.ingest_new_files(spark, src, out, ck, schema)
    ingest.ingest_new_files(spark, src, out, ck, schema)
    assert sorted(r[0] for r in spark.read.schema(schema).parquet(out).collect()) == list(range(15))


def test_weather_keeps_one_station(spark):
    raw = spark.createDataFrame(
        [("75114001", "20150102", "1"), ("1", "20150102", "2"), ("75114001", "20141231", "3")],
        "NUM_POSTE string, AAAAMMJJ string, RR string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("TN", "TX", "TM", "FFM")})
    got = weather.clean_weather(raw).collect()
    assert len(got) == 1 and got[0]["RR"] == 1.0 and str(got[0]["JOUR"]) == "2015-01-02"




def test_ranked_report_is_ordered_with_unknown_last(spark, tmp_path):
    report = spark.createDataFrame([(1, None), (2, 9.0), (3, 4.0), (4, 4.0)], "station_id int, mae_pct double")
    path = sink.save_ranked(report, str(tmp_path / "ranked"))
    back = source.load_results(spark, path, "station_id int, mae_pct double")
    assert sorted((r["mae_pct"] is None, r["mae_pct"] or 0, r["station_id"]) for r in back.collect()) == [
        (False, 4.0, 3), (False, 4.0, 4), (False, 9.0, 2), (True, 0, 1)
    ]
    parts = sorted(p for p in (tmp_path / "ranked").iterdir() if p.name.startswith("part-"))
    rows = [line for p in parts for line in p.read_text().splitlines() if not line.startswith("station_id")]
    assert [int(line.split(",")[0]) for line in rows] == [3, 4, 2, 1]


def test_ingest_counts_rows_of_all_batches(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.range(120).repartition(120, "id").write.option("maxRecordsPerFile", 1).parquet(src)
    got = ingest.ingest_new_files(spark, src, out, ck, "id long", files_per_batch=1)
    assert got == 120 == spark.read.parquet(out).count()


def test_parts_of_a_folder_may_order_their_columns_differently(spark, tmp_path):
    folder = tmp_path / "validations" / "2018-S1-validations.csv"
    folder.mkdir(parents=True)
    names = [c if c != "ID" else "ID_REFA_LDA" for c in HEADER]
    cells = dict(zip(names, ["2018-01-03", "1", "2", "3", "Opéra", "71", "PASS", "20"]))
    swapped = [*names[:5], "NB_VALD", "CATEGORIE_TITRE", "ID_REFA_LDA"]
    for part, order, sep in (("part-0.csv", names, ";"), ("part-1.csv", swapped, ";"), ("part-2.csv", names, "\t")):
        (folder / part).write_text("\n".join(sep.join(row) for row in (order, [cells[c] for c in order])) + "\n", "utf-8")
    (folder / "part-3.csv").write_text("")
    formats = files.require_formats(files.detect_formats(spark, [str(folder)]))
    assert len(formats) == 3
    frames = files.load_source(spark, formats)
    got = [r for f in frames for r in f.select(*names, "ANNEE", "PERIODE").collect()]
    assert [r.asDict() for r in got] == [{**cells, "ANNEE": "2018", "PERIODE": "S1"}] * 3
    with pytest.raises(Exception, match="(?i)header"):
        files.read_files(spark, [str(folder / "part-1.csv")], "utf-8-sig", ";", header=names).collect()
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError, match="no valid format"):
        files.require_formats(files.detect_formats(spark, [str(empty)]))


def test_published_versions_are_whole_and_kept(spark, tmp_path):
    base = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        source.current_path(spark, base)

    def numbers(n):
        return lambda path: spark.range(n).write.parquet(path)

    def broken(path):
        spark.range(9).write.parquet(path)
        raise RuntimeError("lost")

    first = sink.publish(spark, base, numbers(3), "first")
    assert source.current_path(spark, base) == first and spark.read.parquet(first).count() == 3
    with pytest.raises(RuntimeError):
        sink.publish(spark, base, broken)
    assert source.current_path(spark, base) == first
    second = sink.publish(spark, base, numbers(5))
    assert source.current_path(spark, base) == second != first
    # A reader that holds the older path still reads it.
    assert spark.read.parquet(first).count() == 3
    assert [r["note"] for r in source.published(spark, base).collect()] == ["first", ""]


def test_artifacts_keep_fold_scores_and_choices(spark, tmp_path):
    params = spark.createDataFrame([("penalty", 0.3)], "name string, value double")
    choices = spark.createDataFrame([(1, 0.3), (2, 0.1)], "entity int, penalty double")
    path = str(tmp_path / "artifact")
    sink.save_params(params, path, 1.25, [1.0, 1.5], choices, seed=1)
    assert source.load_params(spark, path) == {"penalty": 0.3}
    assert source.load_scores(spark, path) == (1.25, [1.0, 1.5])
    assert sorted(map(tuple, source.load_choices(spark, path).collect())) == [(1, 0.3), (2, 0.1)]
    bare = str(tmp_path / "bare")
    sink.save_params(params, bare)
    assert source.load_scores(spark, bare) == (None, None)


def test_parts_of_one_folder_are_sniffed_by_many_tasks(spark, tmp_path):
    folder = tmp_path / "2020-S1-validations.csv"
    folder.mkdir()
    for part in range(200):
        (folder / f"part-{part}.csv").write_text("JOUR;CODE_STIF_TRNS;CODE_STIF_RES;CODE_STIF_ARRET;LIBELLE_ARRET;CATEGORIE_TITRE;NB_VALD\n")
    found = files.detect_formats(spark, [str(folder)])
    assert found.count() == 200
    tasks = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) >= 8 and max(r["count"] for r in tasks) < 50
    formats = files.require_formats(files.detect_formats(spark, [str(folder)]))
    assert len(formats) == 1 and len(formats[0]["paths"]) == 200


def test_replayed_and_late_batches_give_the_batch_aggregate(spark, tmp_path):
    target = str(tmp_path / "totals")
    kind = "ts timestamp, kind string, value double"

    def batch(*rows):
        return spark.createDataFrame([(dt.datetime(2024, m, d, 5), k, v) for m, d, k, v in rows], kind)

    first = batch((3, 1, "a", 1.0), (3, 20, "a", 2.0))
    second = batch((3, 2, "a", 4.0), (3, 20, "b", 8.0), (3, 14, "a", 1.5))  # the first row's day was closed
    for rows, number in ((first, 0), (second, 1), (second, 1), (first, 0), (second, 1)):
        ingest.upsert_batch(rows, number, target, "ts", "kind", "value")
    whole = {(r["day"].isoformat(), r["entity"]): (r["value"], r["n"]) for r in ingest.upserted_totals(spark, target).collect()}
    want = {("2024-03-01", "a"): (1.0, 1), ("2024-03-20", "a"): (2.0, 1), ("2024-03-02", "a"): (4.0, 1),
            ("2024-03-20", "b"): (8.0, 1), ("2024-03-14", "a"): (1.5, 1)}
    assert whole == want
    assert [(r["value"], r["batch"]) for r in ingest.late_rows(spark, target).collect()] == [(4.0, 1)]
    ingest.compact_totals(spark, target)
    ingest.upsert_batch(batch((3, 1, "a", 10.0)), 2, target, "ts", "kind", "value")
    again = {(r["day"].isoformat(), r["entity"]): (r["value"], r["n"]) for r in ingest.upserted_totals(spark, target).collect()}
    assert again == {**want, ("2024-03-01", "a"): (11.0, 2)}
    ingest.compact_totals(spark, target)
    assert ingest.upserted_totals(spark, target).count() == len(want)


@pytest.mark.parametrize("codec, mark", [("utf-16-be", b"\xfe\xff"), ("utf-16-le", b"\xff\xfe"), ("utf-16-le", b"")])
def test_ranges_of_utf16_files_hold_each_line_once(tmp_path, codec, mark):
    # U+0A.. and U+..00 next to each other hold the bytes of a line feed across characters.
    lines = ["a;b", "1;\u0a0a\u0a00x", "", "\u0100\u0a01;z"] + [f"{k};" + "\u0a0b\u4100" * (k % 5) for k in range(40)]
    for end in ("", "\r\n"):
        path = tmp_path / "x"
        path.write_bytes(mark + ("\r\n".join(lines) + end).encode(codec))
        for size in (2, 6, 50, 64, 1000, 10**6):
            got = []
            for start in range(0, path.stat().st_size, size):
                with path.open("rb") as file:
                    got += utf16.lines_of(file, start, start + size)
            assert got == lines


def test_a_utf16_file_is_read_by_several_tasks(spark, tmp_path):
    names = ["id", "text"]
    rows = [(str(k), f"été {k}" if k % 7 else None) for k in range(3000)]
    body = "\n".join("\t".join(c or "" for c in r) for r in [names, *rows]) + '\n7\t"a ""b"" c"\textra\n8\n'
    paths = [str(tmp_path / n) for n in ("a.txt", "b.txt")]
    for path, codec in zip(paths, ("utf-16", "utf-16-be")):
        mark = "" if codec == "utf-16" else "\ufeff"
        (tmp_path / path).write_bytes((mark + body).encode(codec))
    df = utf16.read_utf16(spark, paths, "\t", names, range_bytes=8192)
    want = sorted([*rows, ("7", 'a "b" c'), ("8", None)] * 2, key=str)
    assert sorted(((r["id"], r["text"]) for r in df.collect()), key=str) == want
    assert df.select(F.spark_partition_id()).distinct().count() > 10
    assert df.groupBy("path").count().count() == 2
    with pytest.raises(Exception, match="header"):
        utf16.read_utf16(spark, paths, "\t", ["id", "other"]).collect()
    (tmp_path / "c.txt").write_bytes('id\ttext\n1\t"two\nlines"\n'.encode("utf-16"))
    with pytest.raises(Exception, match="multi_line"):
        utf16.read_utf16(spark, [str(tmp_path / "c.txt")], "\t", names).collect()
    whole = files.read_files(spark, [str(tmp_path / "c.txt")], "utf-16", "\t", names, names, multi_line=True)
    assert [tuple(r) for r in whole.collect()] == [("1", "two\nlines")]
