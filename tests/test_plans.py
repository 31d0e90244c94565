"""Files in, pairs out; queries against DuckDB."""

import json
import os

import duckdb
import pytest

import __spark_entry__ as contract
from lexiquarry import cli
from lexiquarry.plans import catalog, training_pairs
from lexiquarry.sources import files, sinks
from lexiquarry.streaming import incremental

SF = "/root/testdata/sf0.001"

GOOD = 'class A {\r\n@Test void check() { String name = "x é"; use(name); }\n}'
TORN = 'class B {\n@Test void check() { String name = "a \\\\" b \\\\" c"; use(name); }\n}'


@pytest.fixture
def sources(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "A.java").write_text(GOOD, newline="")
    (d / "B.JAVA").write_text(TORN)
    (d / "Bad.java").write_bytes(b"class C { \xff }")
    (d / "Empty.java").write_text(" \n")
    (d / "note.txt").write_text("no")
    (d / ".java").write_text("class Hidden { }")
    (d / "sub").mkdir()
    (d / "sub" / "D.java").write_text("class D { }")
    return str(d)


def test_run_and_rerun(spark, sources, tmp_path):
    out = str(tmp_path / "out" / "pairs")
    assert training_pairs.run(spark, sources, out, blanked=True) == {"files": 4, "already": 0, "clean": 1, "blanked": 1, "errors": 2}
    row = spark.read.schema(sinks.PAIRS).json(out).first()
    assert (row.source_file, row.prompt) == ("A.java", 'class A {\n@Test void func_1() { String var_1 = "x é"; use(var_1); }\n}')
    assert row.response == GOOD.replace("\r\n", "\n")
    row = spark.read.schema(sinks.PAIRS).json(out + "_blanked").first()
    assert (row.source_file, row.prompt) == ("B.JAVA", 'class B {\n@Test void func_1() { String var_1 = "_"; use(var_1); }\n}')
    errors = {(r.source_file, r.stage) for r in spark.read.json(out + "_errors").collect()}
    assert errors == {("Bad.java", "read"), ("Empty.java", "generate_jsonl")}
    told = []
    again = training_pairs.run(spark, sources, out, blanked=True, tell=lambda name, n: told.append((name, n)))
    assert again == {"files": 4, "already": 2, "clean": 0, "blanked": 0, "errors": 2} and told == list(again.items())
    line = next(x for f in os.listdir(out) if f.endswith(".json") for x in open(f"{out}/{f}"))
    assert list(json.loads(line)) == ["prompt", "response", "source_file"]


def test_a_run_that_broke_off_is_taken_up(spark, sources, tmp_path):
    """Pairs written, ledger not: the pairs themselves tell what is done."""
    out = str(tmp_path / "pairs")
    sinks.write_pairs(spark.createDataFrame([("A.java", "x", "y")], "source_file string, prompt string, response string"), out)
    sinks.Ledger(spark, out).open()
    assert training_pairs.run(spark, sources, out)["already"] == 1
    assert [r.source_file for r in sinks.Ledger(spark, out).done().collect()] == ["A.java"]
    assert not os.path.exists(out + "_done_open")


def test_renamed_files(spark, sources, tmp_path):
    bad = training_pairs.obfuscate_files(spark, sources, str(tmp_path / "renamed"))
    assert [r.source_file for r in bad.collect()] == ["Bad.java"]
    assert sorted(x for x in os.listdir(tmp_path / "renamed") if not x.endswith(".crc")) == ["A.java", "B.JAVA", "Empty.java"]
    assert (tmp_path / "renamed" / "A.java").read_text() == 'class A {\n@Test void func_1() { String var_1 = "x é"; use(var_1); }\n}'


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from lexiquarry.session import shared_root

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://a:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(bare)


def test_without_blanked_sources_are_dropped_and_tried_again(spark, sources, tmp_path):
    out = str(tmp_path / "pairs")
    assert training_pairs.run(spark, sources, str(tmp_path / "x"), out)["blanked"] == 0
    assert training_pairs.run(spark, sources, str(tmp_path / "x"), out, blanked=True)["blanked"] == 1


def test_file_pairs_are_repaired_blanked_and_checked(spark, tmp_path):
    texts = {
        "A.java": ('class A {\r\nint a = f("x",\0 \\\'c\\\');\r\n}', "class A {\nint \\u0076ar_1 = f(\"x\", 'c');\n}"),
        "B.java": ("int a;", "int var_1; ;"),
        "C.java": ("int a;", " \n"),
        "E.java": ('class E { String s = "a \\\\" b"; }', 'class E { String var_1 = "a \\\\" b"; }'),
        "F.java": ("int a;", None),
    }
    for side in (0, 1):
        (tmp_path / str(side)).mkdir()
        for name, both in texts.items():
            if both[side] is not None:
                (tmp_path / str(side) / name).write_text(both[side], newline="")
        (tmp_path / str(side) / "Bad.java").write_bytes(b"int a; \xff" if side else b"int a;")
    left, right = str(tmp_path / "0"), str(tmp_path / "1")
    joined = {r.source_file: (r.original, r.renamed) for r in files.pairs_of_files(spark, left, right).collect()}
    assert sorted(joined) == ["A.java", "B.java", "C.java", "E.java"]
    assert joined["A.java"] == ("class A {\nint a = f(\"x\", 'c');\n}", "class A {\nint var_1 = f(\"x\", 'c');\n}")
    good, bad = training_pairs.pairs_of_files(spark, left, right)
    assert {r.source_file: (r.prompt, r.response) for r in good.collect()} == {
        "A.java": ("class A {\nint var_1 = f(\"_\", 'X');\n}", "class A {\nint a = f(\"_\", 'X');\n}"),
        "E.java": ('class E { String var_1 = "_"; }', 'class E { String s = "_"; }'),
    }
    assert sorted((r.source_file, r.stage) for r in bad.collect()) == [("B.java", "generate_jsonl"), ("Bad.java", "read"), ("C.java", "generate_jsonl")]


def test_stream_takes_new_files_once(spark, sources, tmp_path):
    out, mark = str(tmp_path / "pairs"), str(tmp_path / "mark")
    incremental.start(spark, sources, out, mark, True).awaitTermination(120)
    with open(f"{sources}/E.java", "w") as f:
        f.write("class E { int f() { return 1; } }")
    incremental.start(spark, sources, out, mark, True).awaitTermination(120)
    assert sorted(r.source_file for r in spark.read.schema(sinks.PAIRS).json(out).collect()) == ["A.java", "E.java"]


def test_lines_and_prefixes(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(f"\u2003int m{k}() {{ }} " if k != 3 else "" for k in range(25)))
    numbered = files.lines(spark, str(path))
    assert sorted(r.ordinal for r in numbered.collect()) == list(range(25))
    for size, n in (("s", 4), ("m", 14), ("l", 25)):
        assert files.classes_of(spark, str(path), size).count() == min(25, n)
    made = {r.source_file: r.src for r in files.classes_of(spark, str(path)).collect()}
    assert made["TestClass2.java"] == "public class TestClass2 {\nint m2() { }\n}"
    assert made["TestClass3.java"] == "public class TestClass3 {\n\n}"


def test_lines_of_many_splits(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"line {k} {'x' * (k % 50)}\n" for k in range(5_000)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 10
        got = sorted((r.ordinal, r.line) for r in files.lines(spark, str(path)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == [(k, f"line {k} {'x' * (k % 50)}") for k in range(5_000)]


@pytest.mark.parametrize(("path", "want"), [("a/b/jsonl", "a/b/jsonl_blanked"), ("jsonl", "./jsonl_blanked"), ("/x/y/", "/x/y_blanked"), ("/x", "/x_blanked"), ("", "./jsonl_blanked")])
def test_blanked_sibling(path, want):
    assert sinks.blanked_sibling(path) == want


def test_token_guard(spark):
    rows = spark.createDataFrame([("a", "x y", "x y"), ("b", "x", "x y"), ("c", " \u00a0", "x")], "source_file string, prompt string, response string")
    good, bad = training_pairs.checked(rows, "s")
    assert [r.source_file for r in good.collect()] == ["a"]
    assert {r.source_file: r.error for r in bad.collect()} == {"b": "Token count mismatch: prompt 1, response 2", "c": training_pairs.EMPTY}


def test_pairs_are_exported_as_jsonl_only(spark, tmp_path):
    rows = spark.createDataFrame([("A.java", "x", 'é "y"')], "source_file string, prompt string, response string")
    with pytest.raises(ValueError, match="Output file must have a .jsonl extension"):
        sinks.export_pairs(rows, str(tmp_path / "no"), ".json")
    assert not (tmp_path / "no").exists()
    sinks.export_pairs(rows, str(tmp_path / "yes"))
    assert (tmp_path / "yes" / "A.java.jsonl").read_text() == '{"prompt":"x","response":"é \\"y\\""}\n'


def test_command_line(spark, sources, tmp_path, capsys):
    assert cli.parser().parse_args(["classes", "-f", "a", "-d", "b"]).size == "s"
    assert cli.main(["pairs", "-i", str(tmp_path / "none"), "-o", "x"]) == 1
    assert cli.main(["pairs", "-i", sources, "-o", str(tmp_path / "cli"), "-b"]) == 0
    assert "clean: 1" in capsys.readouterr().out
    root = str(tmp_path / "{split}")
    assert cli.main(["splits", "-i", root, "-o", root + "-out", "in", "in"]) == 0
    said = capsys.readouterr()
    assert "already: 0" in said.out and "already: 1" in said.out and "already 1" in said.err
    assert cli.main(["renamed", "-i", sources, "-o", str(tmp_path / "r")]) == 0 and "Bad.java" in capsys.readouterr().err
    (tmp_path / "l.txt").write_text("int a;\nint b;\n")
    assert cli.main(["classes", "-f", str(tmp_path / "l.txt"), "-d", str(tmp_path / "c"), "-s", "l"]) == 0
    assert sorted(x for x in os.listdir(tmp_path / "c") if x.startswith("source_file")) == ["source_file=TestClass0.java", "source_file=TestClass1.java"]


def test_empty_input(spark):
    pairs = training_pairs.build_pairs(spark.createDataFrame([], "source_file string, src string"))
    assert pairs.clean.count() == pairs.blanked.count() == pairs.errors.count() == 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    found = duck.execute(catalog.ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in found.fetchall())
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
