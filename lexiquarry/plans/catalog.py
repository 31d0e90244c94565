"""The registered queries of the source-code engine and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions import literals, repair
from lexiquarry.functions.register import register
from lexiquarry.functions.tokens import count_tokens
from lexiquarry.operators import kernel, scopes
from lexiquarry.plans import corpus, training_pairs
from lexiquarry.plans.corpus import BLANKED, COLLAPSED, LF, MASKED, RECOVERED, RENAMED, RENAMED_BLANK, REPAIRED, SOURCE, oracle, sources
from lexiquarry.session import shared_root, table
from lexiquarry.sources import files, sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "a15_obfuscate_checked"


def add(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return put


def text_query(name: str, function: Callable, given: str, want: str, column: str = "src") -> None:
    """A query that applies a function of one text to the corpus, and the text it must give."""
    QUERIES[name] = lambda spark, sf_dir: sources(spark, sf_dir, given).select("source_file", function(F.col("src")).alias(column))
    ORACLES[name] = oracle(f"{want} AS {column}")


# --- text operators

TOKENS = r"[A-Za-z0-9_$\x{80}-\x{10FFFF}]+|[^ \t\n\f\r]"


def _tokens(name: str, tab: str, keys: str, text: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: table(spark, sf_dir, tab).select(*keys.split(", "), F.coalesce(count_tokens(F.col(text)), F.lit(0)).cast("long").alias("n_tokens"))
    ORACLES[name] = f"SELECT {keys}, coalesce(len(regexp_extract_all({text}, '{TOKENS}')), 0)::BIGINT AS n_tokens FROM {tab}"


_tokens("t15_count_tokens", "documents", "doc_id", "text")
_tokens("t15_count_tokens_pages", "pages", "page_id", "html")
_tokens("t15_count_tokens_conversations", "conversations", "conv_id, turn", "text")
_tokens("t15_count_tokens_benchmark", "benchmark", "item_id", "text")

_ALL_STEPS = {  # the source after each step of the repair
    "t1a": corpus.template(LF, corpus.RAW, corpus.extra(corpus.ESCAPED)),
    "t2": corpus.template(LF, corpus.by_variant(corpus.PLAIN, v4=corpus.quoted(f"n || {LF}"), v5=corpus.quoted(corpus.CORRUPT)), corpus.extra(corpus.ESCAPED)),
    "t3": corpus.template(LF, corpus.by_variant(corpus.PLAIN, v4=corpus.quoted(f"n || {LF}"), v5=corpus.quoted(corpus.CORRUPT)), corpus.extra()),
}
text_query("t1_repair", repair.repair, SOURCE, REPAIRED)
text_query("t1a_nul_and_line_ends", repair.drop_nul_and_cr, SOURCE, _ALL_STEPS["t1a"])
text_query("t2_unicode_escapes", repair.unescape_unicode, _ALL_STEPS["t1a"], _ALL_STEPS["t2"])
text_query("t3_apostrophes", repair.unescape_apostrophes, _ALL_STEPS["t2"], _ALL_STEPS["t3"])
text_query("t4_line_breaks", repair.escape_line_breaks, _ALL_STEPS["t3"], REPAIRED)
text_query("t5_backslashes", repair.collapse_backslashes, REPAIRED, COLLAPSED)
text_query("t6_repair_all", repair.repair_all, SOURCE, COLLAPSED)
text_query("t9_blank_for_good", literals.blank_for_good, REPAIRED, BLANKED)
text_query("t10_blank", lambda c: literals.blank(c)["out"], REPAIRED, MASKED)
text_query("t11_restore", lambda c: literals.restore(literals.blank(c)["out"], literals.blank(c)["store"]), REPAIRED, REPAIRED)
text_query("t12_blank_source", training_pairs.blank_source, REPAIRED, RECOVERED)
text_query("t16_full_sanitize", repair.repair, SOURCE, REPAIRED)

_STRING = corpus.by_variant(corpus.FIXED, v5=f"{corpus.Q} || n || ' ' || {corpus.BS} || {corpus.BS} || {corpus.Q} || '|' || {corpus.Q} || ' c' || {corpus.Q}")
text_query("t13_closed_literals", lambda c: F.array_join(literals.closed_literals(c), "|"), REPAIRED, _STRING, "found")
text_query("t7_string_literals", lambda c: F.array_join(F.filter(literals.lexemes(c), lambda x: F.startswith(x, F.lit('"'))), "|"), REPAIRED, _STRING, "found")
text_query("t8_char_literals", lambda c: F.array_join(F.filter(literals.lexemes(c), lambda x: F.startswith(x, F.lit("'")) & (F.length(x) > 2)), "|"), REPAIRED, corpus.by_variant("''", v3=f"{corpus.A} || 'Q' || {corpus.A}"), "found")
text_query("t10_store", lambda c: F.array_join(F.transform(literals.blank(c)["store"], lambda e: F.concat(e["placeholder"], F.lit("="), e["original"])), "|"), REPAIRED,
           corpus.by_variant(f"{corpus.Q} || 'STR_0' || {corpus.Q} || '=' || {corpus.FIXED}", v3=f"{corpus.Q} || 'STR_0' || {corpus.Q} || '=' || {corpus.FIXED} || '|' || {corpus.A} || 'X' || {corpus.A} || '=' || {corpus.A} || 'Q' || {corpus.A}",
                             v5=f"{corpus.Q} || 'STR_0' || {corpus.Q} || '=' || {corpus.Q} || n || ' ' || {corpus.BS} || {corpus.BS} || {corpus.Q} || '|' || {corpus.Q} || 'STR_1' || {corpus.Q} || '=' || {corpus.Q} || ' c' || {corpus.Q}"), "found")


@add("t13_literal_spans", oracle(f"strpos({REPAIRED}, {corpus.Q}) - 1 AS first_start, CASE v WHEN 5 THEN 2 ELSE 1 END AS n_spans"))
def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = literals.literal_spans(F.col("src"))
    return sources(spark, sf_dir, REPAIRED).select("source_file", F.get(spans, 0)["start"].cast("long").alias("first_start"), F.size(spans).alias("n_spans"))


@add("t14_take_literals", oracle(f"CASE WHEN v <> 5 THEN {corpus.template(LF, corpus.FIXED, corpus.extra(), **corpus.VAR)} END AS src"))
def _take(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = corpus.template(LF, corpus.quoted("'other'"), corpus.extra(), **corpus.VAR)
    both = corpus.parts(spark, sf_dir).select(F.expr("'TestClass' || k || '.java'").alias("source_file"), F.expr(REPAIRED).alias("prompt"), F.expr(other).alias("response"))
    return both.select("source_file", literals.take_literals(F.col("prompt"), F.col("response")).alias("src"))


@add("t17_identifier", "SELECT c_custkey, nullif(regexp_extract(c_name, '[A-Za-z0-9_$]+'), '') AS name FROM customer")
def _identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", literals.identifier(F.col("c_name")).alias("name"))


# --- syntax operators

_NAMED = dict(corpus.VAR, method=corpus.METHOD)
text_query("f4_has_errors", kernel.has_errors, BLANKED, "v = 5", "broken")
text_query("a1_parse", lambda c: kernel.rename(c)["broken"], RECOVERED, "false", "broken")
text_query("a2_rename_methods", kernel.name_methods, RECOVERED, corpus.template(LF, corpus.BLANK, corpus.extra(f"{corpus.A} || 'X' || {corpus.A}"), method="'func_1'"))
text_query("a14_rename_variables", kernel.name_variables, RECOVERED, corpus.template(LF, corpus.BLANK, corpus.extra(f"{corpus.A} || 'X' || {corpus.A}", "'var_3'"), **_NAMED))
text_query("a12_a13_edits", lambda c: kernel.rename(c)["renamed"], RECOVERED, RENAMED_BLANK)


@add("a15_obfuscate_checked", oracle(f"{RENAMED} AS obfuscated, v = 5 AS needed_fallback"))
def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_pairs.obfuscate(sources(spark, sf_dir, REPAIRED)).select("source_file", "obfuscated", "needed_fallback")


@add("a16_obfuscate", oracle(f"{RENAMED} AS obfuscated"))
def _obfuscate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_pairs.obfuscate(sources(spark, sf_dir, REPAIRED)).select("source_file", "obfuscated")


_CLASS = "'class C' || k || ' { int a = ' || z || ', b; int sum(int a, int x) { int y = x + b; for (int i = 0; i < y; i++) { int x2 = a * i; b += x2; } return a + y; } int twice() { return 2 * b; } }'"
_CLASS_RENAMED = "'class C' || k || ' { int var_1 = ' || z || ', var_2; int func_1(int var_3, int var_4) { int var_5 = var_4 + var_2; for (int var_6 = 0; var_6 < var_5; var_6++) { int var_7 = var_3 * var_6; var_2 += var_7; } return var_3 + var_5; } int func_2() { return 2 * var_2; } }'"
text_query("a3_to_a9_scopes", lambda c: kernel.rename(c)["renamed"], _CLASS, _CLASS_RENAMED)


@add("w1_method_numbers", oracle("unnest(['sum', 'twice']) AS name, unnest(['func_1', 'func_2']) AS new_name"))
def _w1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scopes.identifier_facts(sources(spark, sf_dir, _CLASS))
    return scopes.numbered_methods(found).select("source_file", "name", "new_name")


@add("w1_variable_numbers", oracle("unnest(['a', 'b', 'a', 'x', 'y', 'i', 'x2']) AS name, unnest(['var_1', 'var_2', 'var_3', 'var_4', 'var_5', 'var_6', 'var_7']) AS new_name"))
def _w1v(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scopes.identifier_facts(sources(spark, sf_dir, _CLASS))
    return scopes.numbered_variables(found).select("source_file", "name", "new_name")


def _sql_edits(pattern: str) -> str:
    """Places of the template's names, by the names that replace them: every occurrence of a word in one text or the other."""
    return (
        f"WITH p AS ({corpus.PARTS}), t AS (SELECT 'TestClass' || k || '.java' AS source_file, regexp_extract_all({_CLASS}, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+') AS a,"
        f" regexp_extract_all({_CLASS_RENAMED}, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+') AS b FROM p),"
        " w AS (SELECT source_file, unnest(range(1, len(a) + 1)) AS i, a, b FROM t)"
        " SELECT source_file, len(array_to_string(a[1 : i - 1], ''))::INTEGER AS pos, b[i] AS new_name FROM w"
        f" WHERE regexp_matches(b[i], '{pattern}')"
    )


@add("j4_innermost_scope", _sql_edits("^var_") + " AND a[i - 2] <> 'int' AND NOT (a[i] = 'b' AND i < 14)")
def _j4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scopes.identifier_facts(sources(spark, sf_dir, _CLASS))
    return scopes.resolved_uses(found, scopes.numbered_variables(found)).select("source_file", "pos", "new_name")


@add("g4_last_edit_wins", _sql_edits("^(var|func)_"))
def _g4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scopes.identifier_facts(sources(spark, sf_dir, _CLASS))
    variables = scopes.numbered_variables(found)
    return scopes.edits(variables, scopes.resolved_uses(found, variables), scopes.numbered_methods(found))


# --- routing, guards, sinks


def _pairs(spark: SparkSession, sf_dir: str, blanked: bool = True) -> training_pairs.Pairs:
    return training_pairs.build_pairs(sources(spark, sf_dir).select("source_file", "src"), blanked)


@add("k1_clean_pairs", oracle(f"{RENAMED} AS prompt, {REPAIRED} AS response", "v <> 5"))
def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).clean


@add("k2_blanked_pairs", oracle(f"{RENAMED_BLANK} AS prompt, {RECOVERED} AS response", "v = 5"))
def _blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).blanked


@add("f5_dropped", oracle("5 AS v", "v = 5"))
def _dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, False).dropped.select("source_file", F.lit(5).alias("v"))


@add("f5_routes", f"WITH p AS ({corpus.PARTS}) SELECT CASE v WHEN 5 THEN 'blanked' ELSE 'clean' END AS route, count(*) AS n FROM p GROUP BY 1")
def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir)
    rows = pairs.clean.select(F.lit("clean").alias("route")).unionByName(pairs.blanked.select(F.lit("blanked").alias("route")))
    return rows.unionByName(pairs.errors.select(F.lit("error").alias("route"))).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@add("f6_empty_prompts", oracle(f"'generate_jsonl' AS stage, '{training_pairs.EMPTY}' AS error", "k % 3 = 0"))
def _empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corpus.parts(spark, sf_dir).select(F.expr("'TestClass' || k || '.java'").alias("source_file"), F.expr("CASE WHEN k % 3 = 0 THEN ' ' || chr(10) ELSE n END").alias("prompt"), F.col("n").alias("response"))
    return training_pairs.checked(rows, "generate_jsonl")[1]


@add("f8_token_guard", oracle("'generate_jsonl' AS stage", "k % 4 = 1"))
def _guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corpus.parts(spark, sf_dir).select(F.expr("'TestClass' || k || '.java'").alias("source_file"), F.expr("CASE WHEN k % 4 = 1 THEN n || ' ;' ELSE n END").alias("prompt"), F.col("n").alias("response"))
    return training_pairs.checked(rows, "generate_jsonl")[1].select("source_file", "stage")


@add("k1_json_lines", oracle("'{\"prompt\":\"' || n || '\",\"response\":\"' || z || '\"}' AS line"))
def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corpus.parts(spark, sf_dir)
    return rows.select(F.expr("'TestClass' || k || '.java'").alias("source_file"), sinks.json_line(F.col("n"), F.col("z").cast("string")).alias("line"))


@add("f2_not_done", oracle("v", "v NOT IN (0, 3)"))
def _not_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through files: pairs in both datasets, of which only one is in the ledger yet."""
    path = f"{shared_root(spark)}/pairs-{uuid.uuid4().hex}"
    new = sources(spark, sf_dir).select("source_file", "v")
    ledger = sinks.Ledger(spark, path, sinks.blanked_sibling(path))
    pairs = lambda v: new.filter(F.col("v") == v).select("source_file", F.lit("a").alias("prompt"), F.lit("b").alias("response"))
    sinks.write_pairs(pairs(0), path)
    ledger.done()
    ledger.open()
    sinks.write_pairs(pairs(3), sinks.blanked_sibling(path))
    return new.join(ledger.done(), "source_file", "left_anti")


@add("k1_written_pairs", oracle(f"{RENAMED} AS prompt, {REPAIRED} AS response", "v <> 5"))
def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 through its files."""
    path = f"{shared_root(spark)}/pairs-{uuid.uuid4().hex}"
    sinks.write_pairs(_pairs(spark, sf_dir).clean, path)
    return spark.read.schema(sinks.PAIRS).json(path)


@add("k3_error_files", oracle(f"'generate_jsonl' AS stage, '{training_pairs.EMPTY}' AS error", "k % 3 = 0"))
def _error_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 through its files."""
    path = f"{shared_root(spark)}/errors-{uuid.uuid4().hex}"
    sinks.write_errors(_empty(spark, sf_dir), path)
    return spark.read.schema("stage string, source_file string, error string").json(path)


@add("a17_k4_renamed_files", "SELECT n_name || '.java' AS source_file, 'class N' || n_nationkey || ' { int func_1(int var_1) { return var_1; } }' AS src FROM nation")
def _renamed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _nation_dir(spark, sf_dir, "'class N' || n_nationkey || ' { int f(int ' || chr(0) || 'a) { return a; } }'")
    training_pairs.obfuscate_files(spark, path, f"{path}-renamed")
    return files.texts(files.java_files(spark, f"{path}-renamed"))[0]


@add("x1_sql_functions", oracle(f"{RENAMED_BLANK} AS src, false AS broken"))
def _sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    return sources(spark, sf_dir, RECOVERED).selectExpr("source_file", "java_rename(src).renamed AS src", "java_has_errors(src) AS broken")


@add("g1_counts", f"WITH p AS ({corpus.PARTS}) SELECT count(*) AS files, count(*) FILTER (v = 0) AS done FROM p")
def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("v") == 0).alias("done"))


@add("g3_literal_counts", oracle("CASE v WHEN 5 THEN 2 ELSE 1 END AS n_literals"))
def _literal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir, REPAIRED).select("source_file", F.size(literals.closed_literals(F.col("src"))).alias("n_literals"))


# --- sources; files are written from a small dimension table as a whole and read again


def _nation_dir(spark: SparkSession, sf_dir: str, text: str) -> str:
    path = f"{shared_root(spark)}/nations-{uuid.uuid4().hex}"
    nations = table(spark, sf_dir, "nation").select(F.concat("n_name", F.lit(".java")).alias("source_file"), F.expr(text).alias("text"))
    sinks.export_files(nations, path)
    return path


@add("s1_s2_java_files", "SELECT n_name || '.java' AS source_file, 'class N' || n_nationkey || ' { }' AS src FROM nation")
def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _nation_dir(spark, sf_dir, "'class N' || n_nationkey || ' { }'")
    return files.texts(files.java_files(spark, path))[0]


@add("s3_file_pairs", "SELECT n_name || '.java' AS source_file, 'int a' || n_nationkey || ';' AS original, 'int var_1;' AS renamed FROM nation")
def _file_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = _nation_dir(spark, sf_dir, f"'in' || {corpus.BS} || 'u0074 a' || chr(0) || n_nationkey || ';'")
    right = _nation_dir(spark, sf_dir, f"'int ' || {corpus.BS} || 'U0076ar_1;' || chr(0)")
    return files.pairs_of_files(spark, left, right)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers' names as numbered lines."""
    names = table(spark, sf_dir, "supplier")
    return names.select((F.col("s_suppkey") - 1).alias("ordinal"), F.concat(F.lit(" \t"), "s_name", F.lit(" ")).alias("line"))


@add("s4_line_classes", "SELECT 'TestClass' || (s_suppkey - 1) || '.java' AS source_file, 'public class TestClass' || (s_suppkey - 1) || ' {' || chr(10) || s_name || chr(10) || '}' AS src FROM supplier")
def _classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.classes(_lines(spark, sf_dir))


for _letter, _share in files.SIZES.items():
    QUERIES[f"s5_prefix_{_letter}"] = lambda spark, sf_dir, share=_share: files.prefix(_lines(spark, sf_dir), share).select("ordinal")
    ORACLES[f"s5_prefix_{_letter}"] = f"SELECT s_suppkey - 1 AS ordinal FROM supplier WHERE s_suppkey - 1 <= floor({_share}::DOUBLE * (SELECT count(*) FROM supplier)) + 1"


@add("w2_line_ordinals", "SELECT n_nationkey::BIGINT AS ordinal, n_name AS line FROM nation")
def _ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _nation_dir(spark, sf_dir, "n_name") + "-lines"
    table(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select("n_name").write.mode("overwrite").text(path)
    return files.lines(spark, path)


@add("w2_part_lines", "SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS ordinal, p_partkey || ' ' || p_name AS line FROM part")
def _part_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_root(spark)}/part-lines-{uuid.uuid4().hex}"
    table(spark, sf_dir, "part").coalesce(1).sortWithinPartitions("p_partkey").select(F.concat_ws(" ", "p_partkey", "p_name")).write.text(path)
    return files.lines(spark, path)
