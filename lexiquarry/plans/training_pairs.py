"""From sources to training pairs: repair, mask, rename, check, and route."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions import literals, repair
from lexiquarry.functions.tokens import count_tokens
from lexiquarry.operators.kernel import has_errors, rename_or_recover
from lexiquarry.session import staged
from lexiquarry.sources import files, sinks

EMPTY = "Obfuscated source is empty"


def obfuscate(repaired: DataFrame, text: str = "src") -> DataFrame:
    """Adds obfuscated and needed_fallback to rows of repaired text.

    A sound text is renamed with its literals masked and gets them back. From a broken one doubled backslashes go, its
    literals are blanked for good, and as much as can be read is renamed.
    """
    src = F.col(text)
    staged = repaired.withColumns({"_mask": literals.blank(src), "_recovered": literals.blank_for_good(repair.collapse_backslashes(src))})
    renamed = staged.withColumn("_r", rename_or_recover("_mask.out", "_recovered"))
    out = F.when(F.col("_r.fallback"), F.col("_r.renamed")).otherwise(literals.restore(F.col("_r.renamed"), F.col("_mask.store")))
    return renamed.withColumns({"obfuscated": out, "needed_fallback": F.col("_r.fallback")}).drop("_mask", "_recovered", "_r")


def blank_source(text: Column) -> Column:
    """Literals blanked; from a text that is still broken doubled backslashes go first."""
    once = literals.blank_for_good(text)
    return F.when(has_errors(once), literals.blank_for_good(repair.collapse_backslashes(text))).otherwise(once)


def token_message(prompt: Column, response: Column) -> Column:
    """F8: what is wrong with a pair whose token counts differ; null if nothing is."""
    a, b = count_tokens(prompt), count_tokens(response)
    said = F.concat(F.lit("Token count mismatch: prompt "), a.cast("string"), F.lit(", response "), b.cast("string"))
    return F.when(a != b, said)


@dataclass
class Pairs:
    """clean and blanked: (source_file, prompt, response); errors: (stage, source_file, error)."""

    clean: DataFrame
    blanked: DataFrame
    errors: DataFrame
    dropped: DataFrame


def checked(rows: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """Pairs that pass, and error rows of the others."""
    error = F.when(repair.is_blank(F.col("prompt")), F.lit(EMPTY)).otherwise(token_message(F.col("prompt"), F.col("response")))
    judged = rows.withColumn("error", error)
    bad = judged.filter("error is not null").select(F.lit(stage).alias("stage"), "source_file", "error")
    return judged.filter("error is null").select("source_file", "prompt", "response"), bad


def build_pairs(sources: DataFrame, blanked: bool = True) -> Pairs:
    """pairs of (source_file, src). Renaming runs once; its rows are written by route and read again."""
    repaired = sources.select("source_file", repair.repair(F.col("src")).alias("response"))
    done = staged(obfuscate(repaired, "response"), "renamed", "needed_fallback")
    clean, e1 = checked(done.filter("not needed_fallback").select("source_file", F.col("obfuscated").alias("prompt"), "response"), "generate_jsonl")
    fallback = done.filter("needed_fallback")
    # What a literal holds does not matter to the parser, so a response that needed the fallback is broken when blanked, too.
    recovered = literals.blank_for_good(repair.collapse_backslashes(F.col("response")))
    both = fallback.select("source_file", blank_source(F.col("obfuscated")).alias("prompt"), recovered.alias("response"))
    masked, e2 = checked(both, "generate_jsonl_blanked")
    if not blanked:
        masked, e2 = masked.filter(F.lit(False)), e2.filter(F.lit(False))
    dropped = fallback.filter(F.lit(not blanked)).select("source_file")
    return Pairs(clean, masked, e1.unionByName(e2), dropped)


def pairs_of_files(spark: SparkSession, originals: str, renamed: str) -> tuple[DataFrame, DataFrame]:
    """S3 with T12, F6 and F8: blanked pairs of the files with the same name in two directories, and error rows."""
    both = files.pairs_of_files(spark, originals, renamed)
    blanked = both.select("source_file", blank_source(F.col("renamed")).alias("prompt"), blank_source(F.col("original")).alias("response"))
    good, bad = checked(blanked, "generate_jsonl")
    unread = [files.texts(files.java_files(spark, path))[1] for path in (originals, renamed)]
    return good, bad.unionByName(unread[0].unionByName(unread[1]).distinct())


def run(spark: SparkSession, source_dir: str, output: str, jsonl_output: str | None = None, blanked: bool = False, tell: Callable[[str, int], None] | None = None) -> dict[str, int]:
    """Pairs of a directory of .java files as JSON datasets; files already in the output are not read again.

    Files whose pairs were dropped are tried again by the next run. Gives the numbers of files found and already done,
    and of rows written by kind; tell gets each as soon as it is known (K6).
    """
    found = files.java_files(spark, source_dir)
    return append(spark, found, jsonl_output or output, blanked, tell)


def append(spark: SparkSession, found: DataFrame, target: str, blanked: bool, tell: Callable[[str, int], None] | None = None) -> dict[str, int]:
    """run() for files already listed."""
    out: dict[str, int] = {}

    def told(name: str, n: int) -> None:
        out[name] = n
        if tell:
            tell(name, n)

    sibling = sinks.blanked_sibling(target)
    ledger = sinks.Ledger(spark, target, sibling)
    names = found.select("source_file").withColumn("n", F.lit(1)).join(ledger.done().withColumn("old", F.lit(1)), "source_file", "left")
    counts = names.agg(F.count("n").alias("files"), F.count("old").alias("already")).first()
    told("files", counts["files"])
    told("already", counts["already"])
    good, bad = files.texts(found.join(ledger.done(), "source_file", "left_anti"))
    pairs = build_pairs(good, blanked)
    ledger.open()
    for name, rows, write, path in (
        ("clean", pairs.clean, sinks.write_pairs, target),
        ("blanked", pairs.blanked, sinks.write_pairs, sibling),
        ("errors", bad.unionByName(pairs.errors), sinks.write_errors, f"{target.rstrip('/')}_errors"),
    ):
        seen = Observation(name)
        if rows.isEmpty():
            told(name, 0)
        else:
            write(rows.observe(seen, F.count(F.lit(1)).alias("n")), path)
            told(name, seen.get["n"])
    ledger.close(pairs.clean.select("source_file").unionByName(pairs.blanked.select("source_file")))
    return out


def obfuscate_files(spark: SparkSession, source_dir: str, output: str) -> DataFrame:
    """Each .java file of a directory, repaired and renamed, as a file of the same name; gives error rows."""
    good, bad = files.texts(files.java_files(spark, source_dir))
    renamed = obfuscate(good.select("source_file", repair.repair(F.col("src")).alias("src")))
    sinks.export_files(renamed.select("source_file", F.col("obfuscated").alias("text")), output)
    return bad
