"""The whole run on the 12-row golden fixture written as text (F1), and S8 on a corrupt file."""

import glob
import os

import pytest

from aerolake.plans.workflow import WorkflowConfig, extract_and_load, run_workflow
from aerolake.schema import BRONZE_COLUMNS
from aerolake.sources.parquet import bronze_schema, validate_parquet
from tests.fixtures import F1_ROWS


def fixture_text(rows) -> str:
    lines = [";".join(BRONZE_COLUMNS)]
    for i, (airline, o, d, ref, dep, arr) in enumerate(rows, start=1):
        rec = dict.fromkeys(BRONZE_COLUMNS, "")
        rec.update(id_combinada=str(i), sg_empresa_icao=airline or "", nr_voo=str(100 + i),
                   sg_icao_origem=o or "", sg_icao_destino=d or "",
                   dt_referencia=f'"{ref}"' if ref and "\n" in ref else (ref or ""),
                   dt_partida_real=dep or "", dt_chegada_real=arr or "",
                   nm_municipio_origem="São Paulo")
        lines.append(";".join(rec[c] for c in BRONZE_COLUMNS))
    return "\n".join(lines) + "\n"


def test_workflow_on_golden_fixture(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    # two monthly files, one UTF-8 and one windows-1252
    with open(f"{src}/combinada2025-01.txt", "wb") as f:
        f.write(fixture_text(F1_ROWS[:6]).encode("utf-8"))
    with open(f"{src}/combinada2025-02.txt", "wb") as f:
        f.write(fixture_text(F1_ROWS[6:]).encode("cp1252"))
    cfg = WorkflowConfig(input_dir=src, lake_root=os.path.join(scratch, "lake"),
                         database_prefix="wf_")
    run = run_workflow(spark, cfg)
    stages = {r.stage: r for r in run.stats.collect()}
    assert stages["extract"].files == 2 and stages["load_bronze"].rows == 12
    assert stages["silver"].rows == 12
    silver = spark.table(run.silver_table)
    assert {r.source_file for r in silver.select("source_file").distinct().collect()} == {
        "combinada2025-01.parquet", "combinada2025-02.parquet"}
    assert silver.filter("nm_municipio_origem = 'São Paulo'").count() == 12
    vol = sorted((r.ano, r.mes, r.total_voos, r.total_voos_mes_anterior)
                 for r in spark.table(run.gold_views[1]).collect())
    assert vol == [(2024, 2, 1, None), (2024, 12, 1, 1), (2025, 1, 4, 1), (2025, 2, 1, 4),
                   (2025, 4, 1, 1)]
    failed = {(r.column_name, r.failures) for r in run.tests.collect() if not r.passed}
    assert ("dt_referencia_ts", 4) in failed and ("rota", 1) in failed
    # a second run loads nothing new into bronze
    again = run_workflow(spark, cfg)
    assert {r.stage: r.rows for r in again.stats.collect()}["load_bronze"] == 0
    assert spark.table(again.silver_table).count() == 12


def test_validation_flags_corrupt_and_empty_files(spark, scratch):
    out = os.path.join(scratch, "processed")
    good = spark.createDataFrame([("1", "a.parquet"), ("2", "a.parquet")], "v string, source_file string")
    good.write.partitionBy("source_file").parquet(out)
    bad_dir = os.path.join(out, "source_file=bad.parquet")
    os.makedirs(bad_dir)
    with open(os.path.join(bad_dir, "part-0.parquet"), "wb") as f:
        f.write(b"not a parquet file")
    expected = spark.createDataFrame([("a.parquet",), ("bad.parquet",)], "source_file string")
    got = {r.source_file: (r.rows, r.valid) for r in validate_parquet(
        spark, out, expected, bronze_schema(["v"])).collect()}
    assert got == {"a.parquet": (2, True), "bad.parquet": (0, False)}


def test_bad_files_do_not_stop_the_run(spark, scratch):
    """A processed file that is not Parquet is named, and the valid ones are loaded."""
    src, lake = os.path.join(scratch, "in"), os.path.join(scratch, "lake")
    os.makedirs(src)
    for k in (1, 2):
        with open(f"{src}/m{k}.txt", "w") as f:
            f.write("id_combinada;nr_voo\n" + "".join(f"{i};{k}\n" for i in range(k)))
    cfg = WorkflowConfig(input_dir=src, lake_root=lake)
    stages = []
    first = extract_and_load(spark, cfg, stage=lambda *a: stages.append(a))
    assert first.loaded == {"m1.parquet": 1, "m2.parquet": 2}
    part = glob.glob(f"{lake}/processed/version=*/source_file=m1.parquet/*.parquet")[0]
    with open(part, "w") as f:
        f.write("not parquet")
    with open(f"{src}/m2.txt", "a") as f:
        f.write("9;2\n")
    stages.clear()
    again = extract_and_load(spark, cfg, stage=lambda *a: stages.append(a))
    assert ("validate", "ok", 1, None, "invalid: m1.parquet") in stages
    assert again.loaded == {"m2.parquet": 3} and again.bronze.count() == 4


def write_text(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def rows_of(bronze):
    return sorted((r.id_combinada, r.nr_voo) for r in bronze.collect())


def test_bad_republication_keeps_the_last_good_rows(spark, scratch):
    """Nothing of an earlier version goes before a later one is committed."""
    src, lake = os.path.join(scratch, "in"), os.path.join(scratch, "lake")
    head = "id_combinada;nr_voo\n"
    write_text(src, "a.txt", head + "1;10\n2;20\n")
    write_text(src, "b.txt", head + "3;30\n")
    cfg = WorkflowConfig(input_dir=src, lake_root=lake)
    assert extract_and_load(spark, cfg).loaded == {"a.parquet": 2, "b.parquet": 1}
    kept = [("1", "10"), ("2", "20"), ("3", "30")]

    write_text(src, "a.txt", head + "1;10;LOST\n2;20;LOST\n")
    for _ in range(2):  # the lone bad file, and once more without any change
        stages = []
        again = extract_and_load(spark, cfg, stage=lambda *a: stages.append(a))
        assert not again.stopped and again.loaded == {} and rows_of(again.bronze) == kept
        assert again.failed == {"a.parquet": "a record has more fields than the header"}
        assert ("extract", "failures", 0, None,
                "failed: a.parquet (a record has more fields than the header)") in stages
    failures = cfg.processed_files(spark).manifest.rows().where("reason IS NOT NULL")
    assert failures.count() == 1  # quarantined: not tried again

    write_text(src, "c.txt", head + "4;40\n")
    more = extract_and_load(spark, cfg)
    assert more.loaded == {"c.parquet": 1} and rows_of(more.bronze) == [*kept, ("4", "40")]

    write_text(src, "a.txt", head + "5;50\n")
    mended = extract_and_load(spark, cfg)
    assert mended.failed == {} and mended.loaded == {"a.parquet": 1}
    assert rows_of(mended.bronze) == [("3", "30"), ("4", "40"), ("5", "50")]
    # superseded folders stay until they are asked to go, and readers never saw them
    assert cfg.bronze_files(spark).vacuum() == 1 and cfg.processed_files(spark).vacuum() == 1
    assert rows_of(cfg.current_bronze(spark, mended.columns)) == [("3", "30"), ("4", "40"), ("5", "50")]
    assert not glob.glob(f"{lake}/*/*/source_file=a.parquet/*") or len(
        glob.glob(f"{lake}/processed/version=*/source_file=a.parquet")) == 1


def test_a_lost_run_leaves_nothing_that_readers_see(spark, scratch, monkeypatch):
    """The driver is lost after the data of a step is written and before its commit."""
    from aerolake.sources.manifest import Manifest

    src, lake = os.path.join(scratch, "in"), os.path.join(scratch, "lake")
    write_text(src, "a.txt", "id_combinada;nr_voo\n1;10\n")
    cfg = WorkflowConfig(input_dir=src, lake_root=lake)
    assert extract_and_load(spark, cfg).loaded == {"a.parquet": 1}
    write_text(src, "a.txt", "id_combinada;nr_voo\n1;11\n2;22\n")

    def lost(*_):
        raise KeyboardInterrupt

    for manifest in (cfg.extract_manifest, cfg.load_manifest):
        add = Manifest.add
        monkeypatch.setattr(Manifest, "add", lambda self, rows, at=manifest: (
            lost() if self.directory == at else add(self, rows)))
        with pytest.raises(KeyboardInterrupt):
            extract_and_load(spark, cfg)
        monkeypatch.undo()
        assert rows_of(cfg.current_bronze(spark, ["id_combinada", "nr_voo"])) == [("1", "10")]
    again = extract_and_load(spark, cfg)
    assert again.loaded == {"a.parquet": 2} and rows_of(again.bronze) == [("1", "11"), ("2", "22")]
    assert cfg.processed_files(spark).vacuum() == 2 and cfg.bronze_files(spark).vacuum() == 2
    assert rows_of(cfg.current_bronze(spark, again.columns)) == [("1", "11"), ("2", "22")]


@pytest.mark.parametrize("damage", ["file", "page"])
def test_processed_file_lost_before_the_load_is_taken_again(spark, scratch, monkeypatch, damage):
    from aerolake.plans import workflow

    src, lake = os.path.join(scratch, "in"), os.path.join(scratch, "lake")
    write_text(src, "a.txt", "id_combinada;nr_voo\n1;10\n")
    write_text(src, "b.txt", "id_combinada;nr_voo\n2;20\n")
    cfg = WorkflowConfig(input_dir=src, lake_root=lake)
    monkeypatch.setattr(workflow, "load_checked", lambda *a: 1 / 0)
    assert extract_and_load(spark, cfg).bronze is None
    monkeypatch.undo()
    part = glob.glob(f"{lake}/processed/version=*/source_file=a.parquet/*.parquet")[0]
    if damage == "file":
        with open(part, "w") as f:
            f.write("not parquet")
    else:  # a page, the footer stays sound
        with open(part, "r+b") as f:
            f.seek(10)
            f.write(b"\xff\xff")
    for crc in glob.glob(f"{os.path.dirname(part)}/.*.crc"):
        os.remove(crc)
    assert extract_and_load(spark, cfg).loaded == {"b.parquet": 1}
    last = extract_and_load(spark, cfg)
    assert last.loaded == {"a.parquet": 1} and rows_of(last.bronze) == [("1", "10"), ("2", "20")]


def test_validation_reads_pages(spark, scratch):
    """A damaged page below a sound footer: only reading the content shows it."""
    out = os.path.join(scratch, "processed")
    rows = spark.range(20_000).selectExpr("cast(id * 7919 as string) v", "concat('f', id % 2) source_file")
    rows.coalesce(1).write.option("compression", "none").partitionBy("source_file").parquet(out)
    part = glob.glob(f"{out}/source_file=f1/*.parquet")[0]
    with open(part, "r+b") as f:
        f.seek(os.path.getsize(part) // 3)
        f.write(b"\x00" * 64)
    for crc in glob.glob(f"{out}/source_file=f1/.*.crc"):
        os.remove(crc)
    expected = spark.createDataFrame([("f0",), ("f1",)], "source_file string")

    def valid(**kw):
        found = validate_parquet(spark, out, expected, bronze_schema(["v"]), **kw).collect()
        return {r.source_file: r.valid for r in found}

    assert valid(content=False) == {"f0": True, "f1": True}
    assert valid() == {"f0": True, "f1": False}


def test_versions_and_names(spark, scratch):
    """Files of one name in two folders, a file published again, one without rows, a new column."""
    src, lake = os.path.join(scratch, "in"), os.path.join(scratch, "lake")
    os.makedirs(f"{src}/p")
    os.makedirs(f"{src}/q")

    def write(name, text):
        with open(f"{src}/{name}", "w") as f:
            f.write(text)

    write("p/x.txt", "ID_COMBINADA;sg_empresa_icao\n1;A\n")
    write("q/x.txt", "id_combinada;sg_empresa_icao\n2;B\n3;B\n")
    cfg = WorkflowConfig(input_dir=src, lake_root=lake)
    one = extract_and_load(spark, cfg, recursive=True)
    assert one.loaded == {"p__x.parquet": 1, "q__x.parquet": 2}
    assert extract_and_load(spark, cfg, recursive=True).loaded == {}
    write("p/x.txt", "id_combinada;sg_empresa_icao;nr_voo;extra\n1;A;77;e\n4;A;78;e\n")
    two = extract_and_load(spark, cfg, recursive=True)
    assert two.loaded == {"p__x.parquet": 2}
    rows = sorted((r.id_combinada, r.nr_voo, r.extra) for r in two.bronze.collect())
    assert rows == [("1", "77", "e"), ("2", None, None), ("3", None, None), ("4", "78", "e")]
    write("q/x.txt", "id_combinada;sg_empresa_icao\n")
    three = extract_and_load(spark, cfg, recursive=True)
    assert three.loaded == {} and three.bronze.count() == 2


def test_missing_required_column_raises(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("id_combinada;nr_voo\n1;2\n")
    with pytest.raises(ValueError, match="sg_empresa_icao"):
        run_workflow(spark, WorkflowConfig(input_dir=src, lake_root=os.path.join(scratch, "lake")))


def test_silver_rewrites_touched_months_only(spark, scratch):
    """New, changed and emptied months; another airport dimension; a session that starts anew."""
    from aerolake.sources.manifest import Manifest
    from aerolake.sources.seed import load_airport_seed
    from aerolake.sources.silver_table import refresh_silver

    src, lake = os.path.join(scratch, "in"), os.path.join(scratch, "lake")
    seed = load_airport_seed(spark)

    def publish(name, dates):
        rows = [("GLO", "SBGR", "SBSP", d, d, d) for d in dates]
        write_text(src, name, fixture_text(rows))

    def run(airports=seed, prefix="mo_"):
        load = extract_and_load(spark, cfg)
        from aerolake.sources import catalog
        dbs = catalog.create_layers(spark, lake, prefix)
        done = refresh_silver(spark, cfg.bronze_files(spark), bronze_schema(load.columns), airports,
                              dbs["silver"], cfg.silver_dir, Manifest(spark, cfg.silver_manifest))
        table = spark.table(done.table)
        months = {(r.ano, r.mes): r["count"] for r in table.groupBy("ano", "mes").count().collect()}
        return done, months, {f for f in table.inputFiles()}

    cfg = WorkflowConfig(input_dir=src, lake_root=lake)
    publish("a.txt", ["05/01/2025", "06/01/2025", "bad"])
    publish("b.txt", ["07/02/2025"])
    done, months, files = run()
    assert done.months == ["0", "202501", "202502"]
    assert months == {(2025, 1): 2, (2025, 2): 1, (None, None): 1}
    done, months, same = run()
    assert done.months == [] and same == files
    publish("c.txt", ["08/02/2025", "09/03/2025"])
    done, months, more = run()
    assert done.months == ["202502", "202503"] and done.files_read == 2
    assert months == {(2025, 1): 2, (2025, 2): 2, (2025, 3): 1, (None, None): 1}
    assert {f for f in files if "mes=1" in f or "HIVE" in f} <= more
    publish("a.txt", ["05/04/2025"])  # January and the rows without a date are gone
    done, months, _ = run()
    assert done.months == ["0", "202501", "202504"]
    assert months == {(2025, 2): 2, (2025, 3): 1, (2025, 4): 1}
    done, months, _ = run(airports=seed.where("icao_aerodromo <> 'SBGR'"))
    assert done.months == ["202502", "202503", "202504"]
    assert spark.table(done.table).where("origem_cidade IS NOT NULL").count() == 0
    done, months, _ = run(airports=seed.where("icao_aerodromo <> 'SBGR'"), prefix="mo2_")  # not in this catalog
    assert done.months == [] and months == {(2025, 2): 2, (2025, 3): 1, (2025, 4): 1}
