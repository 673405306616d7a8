"""Text extracts, layers, links and the batch run."""

import gzip
from pathlib import Path

import pytest
from parcelflow.operators import CleanSpec, build_star, clean
from parcelflow.plans import marts, medallion
from parcelflow.sources import (
    discard, extract_links, fresh_dir, keep, latest_per_key, new_version, read_checked_extracts, read_delimited,
    read_extracts, read_layer, scope, shared_dir, stage, union_years, within_scope, write_layer,
)
from parcelflow.sources import delimited
from parcelflow.sources.layers import layer_tables
from pyspark.sql import functions as F
from test_cleaning import LINES


def test_delimited_is_text_with_nulls(spark, tmp_path):
    (tmp_path / "a-2020.txt").write_text("a|b|c\n1||x y\n07|2\n")
    (tmp_path / "other.csv").write_text("z\n9\n")
    df = read_delimited(spark, str(tmp_path), source_column="year")
    assert [t for _, t in df.dtypes] == ["string"] * 4
    assert sorted(map(tuple, df.collect())) == [("07", "2", None, "2020"), ("1", None, "x y", "2020")]


def test_one_scan_refuses_another_header(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a|b\n1|2\n")
    (tmp_path / "b.txt").write_text("b|a\n3|4\n")
    df = read_delimited(spark, str(tmp_path), columns=["a", "b"])
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()
    with pytest.raises(Exception, match="(?i)header"):
        df.select("b").collect()


def test_extracts_are_united_by_name(spark, tmp_path):
    (tmp_path / "ventes-2019.txt").write_text("a|b\n1|2\n")
    (tmp_path / "ventes-2020.txt").write_text("b|a|c\n3|4|5\n")
    (tmp_path / "ventes-2021.txt").write_text("a|b\n6|7\n")
    df = read_extracts(spark, str(tmp_path), source_column="year").select("a", "b", "c", "year")
    assert sorted(map(tuple, df.collect())) == [
        ("1", "2", None, "2019"), ("4", "3", "5", "2020"), ("6", "7", None, "2021"),
    ]


def test_extracts_per_directory(spark, tmp_path):
    for year, header in ((2019, "a|b"), (2020, "b|a")):
        (tmp_path / f"y{year}").mkdir()
        for part in (1, 2):
            (tmp_path / f"y{year}" / f"{part}.txt").write_text(f"{header}\n{part}|x\n")
    df = read_extracts(spark, str(tmp_path), header_per="directory",
                       source_column="year", source_pattern=r"y(\d{4})/[^/]*$")
    assert sorted(map(tuple, df.select("year", "a", "b").collect())) == [
        ("2019", "1", "x"), ("2019", "2", "x"), ("2020", "x", "1"), ("2020", "x", "2"),
    ]


def test_empty_and_unreadable_extracts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a|b\n1|2\n")
    (tmp_path / "empty.txt").write_text("")
    assert read_extracts(spark, str(tmp_path)).collect() == [("1", "2")]
    (tmp_path / "broken.txt.gz").write_bytes(b"\x1f\x8b\x08\x00no gzip")
    with pytest.raises(Exception):
        read_extracts(spark, str(tmp_path), glob="*.txt*")
    left_out = []
    left = read_extracts(spark, str(tmp_path), glob="*.txt*", skip_unreadable=True, left_out=left_out)
    assert left.collect() == [("1", "2")]
    assert [path.rsplit("/", 1)[1] for path in left_out] == ["broken.txt.gz"]


def test_many_small_extracts(spark, tmp_path):
    for n in range(300):
        header = "a|b" if n % 2 else "b|a"
        (tmp_path / f"part-{n}.txt").write_text(f"{header}\n{n}|x\n")
    rows = read_extracts(spark, str(tmp_path)).select("a", "b")
    even, odd = ("x", "{}"), ("{}", "x")
    expected = [tuple(v.format(n) for v in (odd if n % 2 else even)) for n in range(300)]
    assert sorted(map(tuple, rows.collect())) == sorted(expected)


def test_headers_of_many_files_take_few_jobs(spark, tmp_path):
    for n in range(1000):
        (tmp_path / f"part-{n}.txt").write_text("a|b\n" if n % 2 else f"b|a\n{n}|x\n")
    (tmp_path / "blank first.txt").write_text("\n \na|b\n5|z\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    rows = read_extracts(spark, str(tmp_path))
    # Two listings in parallel jobs, the first lines, and one file for each of the two headers.
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs <= 12
    assert rows.count() == 501 and rows.where("a = '5' AND b = 'z'").count() == 1


def test_headers_of_large_files_are_read_without_the_rest(spark, tmp_path, monkeypatch):
    # The rest cannot be read: a compressed file that breaks off far behind its header.
    body = "".join(f"{n}|{n * 7919 % 100003}\n" for n in range(400000))
    whole = gzip.compress(("\n \na|b\n" + body).encode())
    (tmp_path / "a.txt.gz").write_bytes(whole[: len(whole) * 3 // 4])
    (tmp_path / "b.txt").write_text(" \n\n" * 20000)
    (tmp_path / "c.txt").write_text("a|b\n1|2\n")
    monkeypatch.setattr(delimited, "LARGE_FILE", 1 << 14)
    groups, bad = delimited._by_header(spark, str(tmp_path), "|", "*.txt*", "file", False)
    assert [(c, [p.rsplit("/", 1)[1] for p in paths]) for c, paths in groups.items()] == [
        (("a", "b"), ["a.txt.gz", "c.txt"])
    ]
    assert bad == []


def test_rejected_lines_and_files(spark, tmp_path):
    (tmp_path / "2019.txt").write_text("a|b|c\n1|2|3\n4|5\n6|7|8|9\n|\"x|y\"|z\n")
    (tmp_path / "2020.txt").write_text("c|a\n1|2\ncut of")
    whole = gzip.compress(("a|b|c\n" + "".join(f"{n}|{n}|{n * n}\n" for n in range(20000))).encode())
    (tmp_path / "2021.txt.gz").write_bytes(whole)
    (tmp_path / "2022.txt.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "2023.txt.bz2").write_bytes(b"no such file")
    (tmp_path / "2024.txt").write_text("")
    rows, rejected = read_checked_extracts(spark, str(tmp_path), glob="*.txt*", source_column="year")
    assert {r.year: r["count"] for r in rows.groupBy("year").count().collect()} == {"2019": 2, "2020": 1, "2021": 20000}
    assert rows.where("year = '2019' AND b = 'x|y'").count() == 1
    found = {(r.path.rsplit("/", 1)[1], r.record, r.reason) for r in rejected.collect()}
    assert found == {
        ("2019.txt", "4|5", "fields"), ("2019.txt", "6|7|8|9", "fields"), ("2020.txt", "cut of", "fields"),
        ("2022.txt.gz", None, "broken"), ("2023.txt.bz2", None, "broken"),
    }
    assert rows.select("a").where("a > 19998").count() == 1 and rejected.select("reason").count() == 5
    left_out = []
    assert read_extracts(spark, str(tmp_path), glob="*.txt*", skip_unreadable=True, left_out=left_out).count() == 20006
    assert [path.rsplit("/", 1)[1] for path in left_out] == ["2022.txt.gz", "2023.txt.bz2"]
    with pytest.raises(Exception):
        read_extracts(spark, str(tmp_path), glob="*.txt*").count()


def test_broken_file_of_a_directory(spark, tmp_path):
    for year in (2019, 2020):
        (tmp_path / f"y{year}").mkdir()
        for part in (1, 2):
            (tmp_path / f"y{year}" / f"{part}.txt.gz").write_bytes(gzip.compress(b"a|b\n1|x\n"))
    (tmp_path / "y2020" / "1.txt.gz").write_bytes(gzip.compress(b"a|b\n1|x\n")[:-12])
    rows = read_extracts(spark, str(tmp_path), glob="*.gz", header_per="directory", skip_unreadable=True)
    assert rows.count() == 3


def test_no_extract(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_extracts(spark, str(tmp_path))


def test_union_by_position_mixes_columns_and_checks_their_number(spark):
    a = spark.createDataFrame([("1", "2")], "a string, b string")
    b = spark.createDataFrame([("3", "4")], "b string, a string")
    assert sorted(map(tuple, union_years([a, b]).collect())) == [("1", "2"), ("4", "3")]
    assert sorted(map(tuple, union_years([a, b], by="position").collect())) == [("1", "2"), ("3", "4")]
    with pytest.raises(Exception):
        union_years([a, b.select("a")], by="position").collect()


def test_layer_round_trip(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("annee"))
    hot = df.withColumn("annee", F.when(F.col("id") < 900, 1).otherwise(F.col("annee")))
    write_layer({"t": hot, "u": df}, str(tmp_path), {"t": ["annee"]})
    back = read_layer(spark, str(tmp_path), ["t", "u"])
    assert sorted(back["t"].collect()) == sorted(hot.collect())
    assert back["u"].count() == 1000
    assert "PartitionFilters: [isnotnull(annee" in plan_of(back["t"].where("annee = 2"))


def test_layer_is_replaced_in_one_step(spark, tmp_path):
    base = str(tmp_path / "layer")
    old = {"t": spark.range(3), "u": spark.range(5)}
    write_layer(old, base)
    reader = read_layer(spark, base, ["t", "u"])
    with pytest.raises(RuntimeError):
        with new_version(spark, base) as folder:
            spark.range(99).write.parquet(f"{folder}/t")
            raise RuntimeError("the job ends here")
    failing = {"t": spark.range(7), "u": spark.range(7).select(F.raise_error(F.lit("no")).alias("id"))}
    with pytest.raises(Exception, match="no"):
        write_layer(failing, base)
    assert [df.count() for df in read_layer(spark, base, ["t", "u"]).values()] == [3, 5]
    write_layer({"t": spark.range(10)}, base)
    assert [df.count() for df in read_layer(spark, base, ["t", "u"]).values()] == [10, 5]
    # A reader that began before the write goes on.
    assert [df.count() for df in reader.values()] == [3, 5]
    write_layer(old, base)
    write_layer(old, base)
    assert layer_tables(spark, base) == ["t", "u"]
    assert len([p for p in (tmp_path / "layer").iterdir() if p.is_dir()]) == 2


def test_layer_without_manifest_is_read(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/t")
    assert layer_tables(spark, str(tmp_path)) == ["t"]
    assert read_layer(spark, str(tmp_path), ["t"])["t"].count() == 4


def test_scope_deletes_what_was_kept_in_it(spark):
    paths = []

    def build(fail=False):
        frame = keep(spark.range(3), "passing")
        paths.append(frame.inputFiles()[0].rsplit("/", 1)[0])
        inner = within_scope(spark, "inner", lambda: keep(frame.union(frame), "twice"))
        paths.append(inner.inputFiles()[0].rsplit("/", 1)[0])
        return inner.where("1 / 0 = 1") if fail else inner

    result = within_scope(spark, "outer", build)
    assert result.count() == 6
    with pytest.raises(Exception):
        within_scope(spark, "failing", lambda: build(fail=True))
    for path in paths:
        with pytest.raises(Exception):
            spark.read.parquet(path).count()
    left = Path(shared_dir(spark).removeprefix("file:"))
    assert not [p for p in left.iterdir() if p.name.startswith(("failing", "outer-")) and p.name not in result.inputFiles()[0]]


def test_threads_keep_their_tables_in_the_scope(spark):
    before = set(Path(shared_dir(spark)).iterdir())
    clean_rows = spark.createDataFrame(SALES, "annee int, mois int, jour int, code_commune int, commune string, "
        "code_postal int, code_departement int, nature_mutation string, nombre_de_lots int, type_local string, "
        "code_type_local string, surface_reelle_bati double, nombre_pieces_principales int, "
        "identifiant_de_document string, valeur_fonciere double, surface_terrain double, prix_a_payer double")
    with scope(spark):
        assert build_star(clean_rows).facts.count() == 2
    assert set(Path(shared_dir(spark)).iterdir()) == before


SALES = [(2020, 1, n, n, "c", 1, 75, "Vente", 1, "Maison", "1", 50.0, 3, str(n), 1e5 * n, 10.0, 1e5) for n in (1, 2)]


def test_writes_leave_no_shuffle_setting(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    keep(spark.range(100).repartition(5, "id"), "shuffled")
    assert spark.conf.get(name) == before


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_table_knows_its_size(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int")
    staged = stage(df, "sizes")
    assert (staged.rows, staged.bytes) == (2, 2 + 8 * 4)
    assert staged.df.columns == ["s", "n"]
    empty = stage(df.where("n > 5"), "empty")
    assert (empty.rows, empty.bytes, empty.df.count()) == (0, 0, 0)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_discard_deletes_only_shared_tables(spark, tmp_path):
    base = fresh_dir(spark, "passing")
    kept, gone = keep(spark.range(3), "kept"), keep(spark.range(3), "gone", base=base)
    assert gone.count() == 3
    discard(spark, base)
    with pytest.raises(Exception):
        spark.read.parquet(f"{base}/gone").count()
    assert kept.count() == 3
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path))


PAGE = """<html><!-- <a href="https://x/valeursfoncieres-1999.zip">no</a> -->
<script>var a = '<a href="https://x/valeursfoncieres-1998.zip">';</script>
<link href="https://x/valeursfoncieres-2000.zip">
<a class="b" href="https://x/valeursfoncieres-2021.txt.zip">2021</a>
<A HREF = 'https://x/get?a=1&amp;f=valeursfoncieres-2022.zip'>2022</A>
<a href="https://x/notice-2022.pdf">notice</a><a data-href="https://x/valeursfoncieres-1.zip">no</a>
<a href="https://y/valeursfoncieres-2021.zip">again</a>
<a href="it's/valeursfoncieres-2019.zip"></a><a id=x href=z/valeursfoncieres-2018.zip>bare</a></html>"""


def test_links(spark):
    pages = spark.createDataFrame([(2, PAGE), (1, "<a href='z/valeursfoncieres-2022.zip'>")], "page_id int, html string")
    links = extract_links(pages)
    assert sorted((r.page_id, r.link_key, r.href) for r in links.collect()) == [
        (1, "2022", "z/valeursfoncieres-2022.zip"),
        (2, "2018", "z/valeursfoncieres-2018.zip"),
        (2, "2019", "it's/valeursfoncieres-2019.zip"),
        (2, "2021", "https://x/valeursfoncieres-2021.txt.zip"),
        (2, "2021", "https://y/valeursfoncieres-2021.zip"),
        (2, "2022", "https://x/get?a=1&f=valeursfoncieres-2022.zip"),
    ]
    assert {r.link_key: r.href for r in latest_per_key(links).collect()} == {
        "2018": "z/valeursfoncieres-2018.zip",
        "2019": "it's/valeursfoncieres-2019.zip",
        "2021": "https://y/valeursfoncieres-2021.zip",
        "2022": "https://x/get?a=1&f=valeursfoncieres-2022.zip",
    }


def test_batch_run(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    header, *rows = LINES.splitlines()
    (raw / "ventes-2022.txt").write_text("\n".join([header, *rows[2:]]) + "\n")
    (raw / "ventes-2023.txt").write_text("\n".join([header, *rows[:2]]) + "\n")
    out = str(tmp_path / "out")
    star = medallion.run(spark, str(raw), out)
    assert marts.inner_star_count(star).first()[0] == 2
    assert marts.left_star(star).count() == 3
    assert read_layer(spark, f"{out}/bronze", [medallion.BRONZE_TABLE])[medallion.BRONZE_TABLE].count() == 4
    assert spark.sql("SELECT count(*) FROM facts JOIN dim_temps USING (id_temps)").first()[0] == 2
    assert star.facts_of_years(2023, 2023).count() == 2
    before = sorted(map(str, star.facts.collect()))
    assert sorted(map(str, medallion.run(spark, str(raw), out).facts.collect())) == before


def test_star_does_not_depend_on_limits(spark, tmp_path):
    (tmp_path / "a.txt").write_text(LINES)
    rows = stage(clean(read_delimited(spark, str(tmp_path)), CleanSpec()), "clean").df
    plain = build_star(rows)
    forced = build_star(rows, broadcast_bytes=0)
    for name, table in plain.tables.items():
        columns = sorted(table.columns)
        assert sorted(map(str, table.select(columns).collect())) == sorted(
            map(str, forced.tables[name].select(columns).collect())
        )
    assert sorted(map(str, marts.left_star(plain).collect())) == sorted(
        map(str, marts.left_star(forced).collect())
    )


def test_medallion_without_any_date(spark, tmp_path):
    """The year of every row is missing; its type is known all the same."""
    from parcelflow.plans import proxy

    header = list(proxy._text_columns())
    rows = ["|".join(header)] + ["|".join("?" if h == "Date mutation" else "1" for h in header)] * 2
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "extrait-2020.txt").write_text("\n".join(rows) + "\n")
    star = medallion.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert star.facts.count() == star.facts.where("id_temps IS NULL AND annee IS NULL").count() > 0
