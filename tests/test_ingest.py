"""S1-S14 on tiny hand-made files (F4): encodings, tokens, quotes, ragged rows, lineage."""

import os

import pytest
from pyspark.sql import functions as F

from aerolake.sources.encoding import detect_encodings
from aerolake.sources.parquet import parquet_profile, read_processed, validate_parquet
from aerolake.sources.text import extract_text_files, list_inputs, require_inputs
from aerolake.streaming.incremental import bronze_row_count, load_incremental

HEADER = "id_combinada;sg_empresa_icao;nm_municipio_origem"


def write(path, text, encoding="utf-8", bom=b""):
    with open(path, "wb") as f:
        f.write(bom + text.encode(encoding))


@pytest.fixture
def inputs(scratch):
    d = os.path.join(scratch, "in")
    os.makedirs(d)
    body = HEADER + "\n1;GLO;São Paulo\n2;TAM;Belém\n"
    write(f"{d}/utf8.txt", body)
    write(f"{d}/utf8bom.txt", body, bom=b"\xef\xbb\xbf")
    write(f"{d}/cp1252.txt", body, "cp1252")
    write(f"{d}/latin1_81.txt", HEADER + "\n1;GLO;S\x81o\n", "latin-1")
    write(f"{d}/utf16.txt", body, "utf-16")          # Python writes little-endian + BOM
    write(f"{d}/utf16be.txt", body, "utf-16-be", bom=b"\xfe\xff")
    write(f"{d}/late_accent.txt", HEADER + "\n" + "".join(f"{i};AAA;x\n" for i in range(6000))
          + "9;GLO;Goiânia\n", "cp1252")
    write(f"{d}/too_many.txt", HEADER + "\n1;GLO;x\n2;TAM;y;extra\n")
    write(f"{d}/too_few.txt", HEADER + "\n1;GLO\n2;TAM;y\n")
    write(f"{d}/tokens.txt", HEADER + '\nNA;NULL;\n;n/a;"x ""q"" y"\n3;AZU;"a;b"\n')
    write(f"{d}/multiline.txt", HEADER + '\n1;GLO;"line one\nline two"\n2;TAM;z\n')
    write(f"{d}/header_only.txt", HEADER + "\n")
    write(f"{d}/empty.txt", "")
    write(f"{d}/ignored.csv", HEADER + "\n1;X;y\n")
    return d


def test_listing(spark, inputs, scratch):
    names = sorted(r.file_name for r in list_inputs(spark, inputs).collect())
    # zero-length files yield no split, so Spark's listing does not return them
    assert "ignored.csv" not in names and "empty.txt" not in names and len(names) == 12
    missing = list_inputs(spark, os.path.join(scratch, "nope"))
    assert missing.count() == 0
    with pytest.raises(FileNotFoundError):
        require_inputs(missing)


def test_encoding_detection(spark, inputs):
    prof = {r.file_name: r for r in detect_encodings(spark, inputs + "/*.txt").collect()}
    assert prof["utf8.txt"].encoding == "UTF-8"
    assert prof["utf8bom.txt"].encoding == "UTF-8"
    assert prof["cp1252.txt"].encoding == "windows-1252"
    assert prof["latin1_81.txt"].encoding == "ISO-8859-1"
    assert prof["utf16.txt"].encoding == "UTF-16LE" and not prof["utf16.txt"].multiline
    assert prof["utf16be.txt"].encoding == "UTF-16BE"
    assert prof["late_accent.txt"].encoding == "windows-1252"   # byte after the first 50,000
    assert prof["too_many.txt"].too_many_fields and not prof["too_few.txt"].too_many_fields
    assert prof["multiline.txt"].multiline
    assert "empty.txt" not in prof


def test_extract_values_and_failures(spark, inputs, scratch):
    paths = [r.path for r in list_inputs(spark, inputs).collect()]
    out = os.path.join(scratch, "processed")
    res = extract_text_files(spark, paths, out)
    assert sorted(res.failed) == ["too_many.txt"]
    assert res.stats()["sucessos"] == 11 and res.stats()["falhas"] == 1
    df = read_processed(spark, out)
    rows = {(r.source_file, r.id_combinada): r for r in df.collect()}
    for f in ("utf8", "utf8bom", "cp1252", "utf16", "utf16be"):
        assert rows[(f + ".parquet", "1")].nm_municipio_origem == "São Paulo"
        assert rows[(f + ".parquet", "2")].nm_municipio_origem == "Belém"
    assert rows[("late_accent.parquet", "9")].nm_municipio_origem == "Goiânia"
    assert rows[("latin1_81.parquet", "1")].nm_municipio_origem == "S\x81o"
    assert rows[("too_few.parquet", "1")].nm_municipio_origem is None       # short row kept
    tok = [r for r in df.collect() if r.source_file == "tokens.parquet"]
    assert {(r.id_combinada, r.sg_empresa_icao, r.nm_municipio_origem) for r in tok} == {
        (None, None, None), (None, None, 'x "q" y'), ("3", "AZU", "a;b")}
    ml = {r.id_combinada: r.nm_municipio_origem for r in df.collect() if r.source_file == "multiline.parquet"}
    assert ml == {"1": "line one\nline two", "2": "z"}
    assert not any(r.source_file == "too_many.parquet" for r in df.collect())
    prof = {r.source_file: r.rows for r in parquet_profile(spark, out).collect()}
    assert "header_only.parquet" not in prof and prof["utf8.parquet"] == 2
    expected = spark.createDataFrame([("utf8.parquet",), ("header_only.parquet",)], "source_file string")
    valid = {r.source_file: r.valid for r in validate_parquet(
        spark, out, expected, df.schema).collect()}
    assert valid == {"utf8.parquet": True, "header_only.parquet": False}


def test_reextract_is_idempotent(spark, inputs, scratch):
    paths = [r.path for r in list_inputs(spark, inputs).collect()]
    out = os.path.join(scratch, "processed")
    extract_text_files(spark, paths, out)
    n1 = read_processed(spark, out).count()
    extract_text_files(spark, paths[:3], out)     # replaces only those files' partitions
    assert read_processed(spark, out).count() == n1


LONG_QUOTED = [
    ("plain", "x" * 1_000_000), ("doubled", '""' * 500_000), ("separators", "a;" * 500_000),
    ("lines", "line one\nline two;\n\n" * 40_000)]


def test_long_quoted_fields_and_unclosed_quotes(spark, scratch):
    """Fields of 1 MB are read whole; a quote that is never closed fails its file only."""
    d, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(d)
    for name, text in LONG_QUOTED:
        write(f"{d}/{name}.txt", f'id_combinada;nr_voo;ds_di\n1;"{text}";k\n2;b;c\n')
    write(f"{d}/unclosed.txt", 'id_combinada;nr_voo;ds_di\n1;"tela 12;k\n' + "2;b;c\n" * 5000)
    res = extract_text_files(spark, [r.path for r in list_inputs(spark, d).collect()], out)
    assert res.failed == ["unclosed.txt"] and list(res.reasons.values()) == ["a quote is never closed"]
    got = {(r.source_file[:-8], r.id_combinada): (r.nr_voo, r.ds_di) for r in read_processed(spark, out).collect()}
    for name, text in LONG_QUOTED:
        assert got.pop((name, "1")) == (text.replace('""', '"'), "k")
        assert got.pop((name, "2")) == ("b", "c")
    assert not got


def spanning_text(rng, n):
    """Records with quoted fields over several lines, and the rows a reader gives."""
    rows, lines = [], []
    for i in range(n):
        parts = [rng.choice(["a", ";", "\n", '""', "x y", "\r\n", "é"]) for _ in range(rng.randrange(0, 9))]
        quoted = rng.random() < 0.5
        text = "".join(parts) if quoted else rng.choice(["plain", 'tela 12" x', "", "é"])
        lines.append(f'{i};"{text}";k{i}' if quoted else f"{i};{text};k{i}")
        value = text.replace('""', '"') if quoted else text
        rows.append((str(i), value or None, f"k{i}"))
    return lines, rows


@pytest.mark.parametrize("encoding, end", [("utf-8", "\n"), ("utf-8", "\r\n"), ("cp1252", "\n"), ("utf-16", "\n")])
def test_spanning_records_are_read_by_many_tasks(spark, scratch, encoding, end):
    import random

    lines, rows = spanning_text(random.Random(4), 600)
    d, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(d)
    with open(f"{d}/m.txt", "wb") as f:
        f.write(end.join(["id_combinada;nr_voo;ds_di", *lines, ""]).encode(encoding))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        from aerolake.sources.records import read_lines, stitch_records

        charset = {"utf-8": "UTF-8", "cp1252": "windows-1252", "utf-16": "UTF-16LE"}[encoding]
        path = [r.path for r in list_inputs(spark, d).collect()]
        read = read_lines(spark, path, charset)
        assert read.rdd.getNumPartitions() > 10 and read.select("block").distinct().count() > 10
        records, unclosed = stitch_records(spark, path, charset)
        assert not unclosed and {r.fields for r in records.collect()} == {3}
        assert extract_text_files(spark, path, out).failed == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = [(r.id_combinada, r.nr_voo, r.ds_di) for r in read_processed(spark, out).collect()]
    assert sorted(got, key=lambda r: int(r[0])) == rows


def test_quote_scanner_equals_a_plain_one(spark):
    """Every short line over the characters that matter, begun outside and inside."""
    import itertools

    from aerolake.sources.encoding import scan_quotes

    def plain(line, inside):
        state, at_start, separators = ("in" if inside else "out"), not inside, 0
        i = 0
        while i < len(line):
            c = line[i]
            if state == "in":
                if c == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif c == '"':
                    state, at_start = "out", False
            elif c == ";":
                separators, at_start = separators + 1, True
            else:
                state = "in" if c == '"' and at_start else "out"
                at_start = False
            i += 1
        return state == "in", separators

    lines = ["".join(p) for n in range(7) for p in itertools.product('";x', repeat=n)]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = df.select("line", scan_quotes(F.col("line")).alias("out"),
                    scan_quotes(F.col("line"), inside=True).alias("in")).collect()
    for r in got:
        assert tuple(r["out"]) == plain(r.line, False), r.line
        assert tuple(r["in"]) == plain(r.line, True), r.line


def test_incremental_load_once(spark, inputs, scratch):
    paths = [r.path for r in list_inputs(spark, inputs).collect()]
    out, bronze, ckpt = (os.path.join(scratch, x) for x in ("processed", "bronze", "ckpt"))
    extract_text_files(spark, paths, out)
    total = read_processed(spark, out).count()
    first = load_incremental(spark, out, bronze, ckpt)
    second = load_incremental(spark, out, bronze, ckpt)
    assert first.rows_added == total and second.rows_added == 0
    assert bronze_row_count(spark, bronze) == total
    per_file = spark.read.parquet(bronze).groupBy("source_file").count()
    assert per_file.filter(F.col("source_file") == "utf8.parquet").first()["count"] == 2


def test_type_profile_detects_drift(spark, scratch):
    from aerolake.sources.parquet import column_type_profile, type_drift

    d = os.path.join(scratch, "drift")
    os.makedirs(d)
    write(f"{d}/a.txt", "nr_voo;kg_carga_paga;nm_empresa\n1;1,5;GOL\n2;3;TAM\n")
    write(f"{d}/b.txt", "nr_voo;kg_carga_paga;nm_empresa\nAB12;2;AZUL\n3;;GOL\n")
    paths = [r.path for r in list_inputs(spark, d).collect()]
    out = os.path.join(scratch, "p")
    extract_text_files(spark, paths, out)
    prof = {(r.source_file, r.column_name): r.inferred_type
            for r in column_type_profile(read_processed(spark, out)).collect()}
    assert prof[("a.parquet", "nr_voo")] == "bigint" and prof[("b.parquet", "nr_voo")] == "string"
    assert prof[("a.parquet", "kg_carga_paga")] == "double"
    assert prof[("b.parquet", "kg_carga_paga")] == "bigint"
    drift = {r.column_name: r.inferred_types for r in type_drift(column_type_profile(read_processed(spark, out))).collect()}
    assert drift == {"nr_voo": ["bigint", "string"], "kg_carga_paga": ["bigint", "double"]}


def test_incremental_load_in_bounded_batches(spark, inputs, scratch):
    """With a file cap per micro-batch the backlog is committed in several batches; rows are
    counted in the sink, however few batches the query remembers."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    paths = [r.path for r in list_inputs(spark, inputs).collect()]
    out, bronze, ckpt = (os.path.join(scratch, x) for x in ("processed", "bronze", "ckpt"))
    extract_text_files(spark, paths, out)
    total = read_processed(spark, out).count()
    files = len([d for d in os.listdir(out) if d.startswith("source_file=")])
    stats = load_incremental(spark, out, bronze, ckpt, max_files_per_batch=3)
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert stats.rows_added == total and stats.files == files
    assert stats.as_dict() == {"total_linhas": total, "arquivos": files, "falhas": 0}
    assert bronze_row_count(spark, bronze) == total
    assert load_incremental(spark, out, bronze, ckpt, max_files_per_batch=3).rows_added == 0


def test_processed_names_agree(spark):
    """The reader's lineage column and the driver-side name rule give the same names."""
    from pyspark.sql import functions as F

    from aerolake.sources.text import processed_file_name, processed_name

    names = ["a.txt", "combinada2025-01.txt", "part-0001-x.c000.csv", "noext", "a.b.c"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = [r[0] for r in df.select(processed_name(F.col("file_name"))).collect()]
    assert got == [processed_file_name(n) for n in names]
    assert got[:2] == ["a.parquet", "combinada2025-01.parquet"] and got[3] == "noext.parquet"


PORTUGUESE = ("São Paulo Goiânia Belém Brasília Maceió Florianópolis Cuiabá Macapá Vitória "
              "Ribeirão Preto ação não atenção três pôde à noite avô saúde órgão índio").split()


def test_code_pages_are_told_apart(spark, scratch):
    """cp860, Mac Turkish and windows-1252 text, in small and capital letters, long and short."""
    from aerolake.sources.text import CP860, MAC_TURKISH

    d, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(d)
    pages = {"cp1252": "windows-1252", "cp860": CP860, "mac_turkish": MAC_TURKISH}
    want = {}
    for codec, java in pages.items():
        for kind, words in (("all", PORTUGUESE), ("caps", [w.upper() for w in PORTUGUESE]), ("one", ["São"])):
            name = f"{codec}_{kind}"
            write(f"{d}/{name}.txt", HEADER + "\n" + "".join(f"{i};GLO;{w}\n" for i, w in enumerate(words)), codec)
            want[f"{name}.parquet"] = (java, words)
    # signs of typesetting do not make a file another page's
    signs = ["“aspas” – e…", "l’água", "R$ 5 • 1º"] * 200
    write(f"{d}/signs.txt", HEADER + "\n" + "".join(f"{i};GLO;{w}\n" for i, w in enumerate(signs)), "cp1252")
    want["signs.parquet"] = ("windows-1252", signs)
    res = extract_text_files(spark, [r.path for r in list_inputs(spark, d).collect()], out)
    assert res.encodings == {n: java for n, (java, _) in want.items()}
    got = {}
    for r in read_processed(spark, out).collect():
        got.setdefault(r.source_file, {})[int(r.id_combinada)] = r.nm_municipio_origem
    assert got == {n: dict(enumerate(words)) for n, (_, words) in want.items()}


def test_encoding_override_is_followed(spark, scratch):
    from aerolake.sources.text import CP860

    d, out = os.path.join(scratch, "dos"), os.path.join(scratch, "p")
    os.makedirs(d)
    write(f"{d}/dos.txt", HEADER + "\n1;GLO;\u201cx\u201d\n", "cp1252")
    paths = [r.path for r in list_inputs(spark, d).collect()]
    res = extract_text_files(spark, paths, out, encoding_overrides={"dos.txt": CP860})
    assert res.encodings == {"dos.parquet": CP860}
    assert read_processed(spark, out).first().nm_municipio_origem == "ôxö".replace("ö", "õ")


def test_reader_keeps_or_fails(spark, scratch):
    """Extra fields fail a file, whatever its encoding and quotes; nothing else is lost."""
    d, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(d)

    def write(name, data):
        with open(f"{d}/{name}.txt", "wb") as f:
            f.write(data)

    write("extra_multiline", '"a\nb";y;z\n2;y;z;LOST1;LOST2\n'.join(["id_combinada;nr_voo;ds_di\n", ""]).encode())
    write("extra_accent", "id_combinada;nr_voo;ds_di\n4;5;é;;\n".encode("cp1252"))
    write("extra_utf16", "id_combinada;nr_voo;ds_di\n4;5;é;6\n".encode("utf-16"))
    write("good_utf16", "id_combinada;nr_voo;ds_di\n4;5;Ļ㬻\n".encode("utf-16"))
    write("crlf_utf16", "id_combinada;nr_voo;ds_di\r\n1;2;SP\r\n3;4;\r\n5;6;\"q;r\"\r\n".encode("utf-16"))
    write("mixed_utf16", "id_combinada;nr_voo;ds_di\r\n1;2;SP\r\n3;4;RJ\n5;6;\r\n".encode("utf-16"))
    write("stray", 'id_combinada;nr_voo;ds_di\n1;tela 12" x;k\n2;"a ""b""";c\n'.encode())
    write("repeated", "id_combinada;ds_di;nr_voo;DS_DI\n1;REGULAR;7;x\n".encode())
    res = extract_text_files(spark, [r.path for r in list_inputs(spark, d).collect()], out)
    assert res.failed == ["extra_accent.txt", "extra_multiline.txt", "extra_utf16.txt"]
    got = {}
    for r in read_processed(spark, out).collect():
        got.setdefault(r.source_file[:-8], []).append((r.id_combinada, r.nr_voo, r.ds_di, r["DS_DI.1"]
                                                       if "DS_DI.1" in r else r["ds_di.1"]))
    assert got["good_utf16"] == [("4", "5", "Ļ㬻", None)]
    assert sorted(got["crlf_utf16"]) == [("1", "2", "SP", None), ("3", "4", None, None), ("5", "6", "q;r", None)]
    assert sorted(got["mixed_utf16"]) == [("1", "2", "SP", None), ("3", "4", "RJ", None), ("5", "6", None, None)]
    assert sorted(got["stray"]) == [("1", 'tela 12" x', "k", None), ("2", 'a "b"', "c", None)]
    assert got["repeated"] == [("1", "7", "REGULAR", "x")]
    prof = {r.file_name: r.multiline for r in res.profile.collect()}
    assert not prof["stray.txt"] and prof["extra_multiline.txt"]


def test_same_name_in_two_folders_needs_the_root(spark, scratch):
    from aerolake.sources.text import unique_names

    with pytest.raises(ValueError):
        unique_names(["/a/p/x.txt", "/a/q/x.txt"], None)
    assert set(unique_names(["file:/a/p/x.txt", "/a/q/x.txt"], "/a").values()) == {
        "p__x.parquet", "q__x.parquet"}
