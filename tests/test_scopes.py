"""Joins and windows over identifier facts give the kernel's edits."""

from lexiquarry.operators import rename, scopes
from tests.test_java import CASES, SOUND


def test_relational_edits_equal_the_kernel(spark):
    texts = [c[0] for c in CASES] + SOUND
    found = scopes.identifier_facts(spark.createDataFrame([(f"f{k}", t) for k, t in enumerate(texts)], "source_file string, src string")).persist()
    variables = scopes.numbered_variables(found)
    edits = scopes.edits(variables, scopes.resolved_uses(found, variables), scopes.numbered_methods(found)).collect()
    by: dict[str, dict[int, str]] = {}
    for e in edits:
        by.setdefault(e.source_file, {})[e.pos] = e.new_name
    for k, text in enumerate(texts):
        out, at = "", 0
        for pos, new in sorted(by.get(f"f{k}", {}).items()):
            a, b = rename.identifier_span(text[pos:])
            out += text[at : pos + a] + new
            at = pos + b
        assert out + text[at:] == rename.rename(text)[1], text
    found.unpersist()
