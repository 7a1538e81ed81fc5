"""Calls, imports and where calls lead, on literal source files."""

from codequarry.operators import calls, extract

SOURCE = """import { make_part as make, other, type Kind } from '@lib/parts.core' // import { no } from 'no'
import def, * as ns from "tools"
import fs from 'fs';
import 'side-effect'
export { again } from './again'
const req = require('old-lib')

@Entry(1)
export class A extends B {
  size = make(1)
  constructor(n: string) { super(n) }
  abstract go(x: number): void
  run(list: number[]) {
    if (check(list)) { return ns.deep.call(list, q => { return make(q) }) }
    const t = `${other(`(${t})`)} fake( ${1}`
    return /call(/.test(t)
  }
}
function helper(cb: (x: number) => void) {
  function inner(a = fallback()) {
    return helper(
      a
    )
  }
  inner?.(1); inner<string>(2)
  new Thing().chain() // comment(call)
  return "text(call)"
}
interface I { go(x: number): void }
helper(x => x)
import('lazy').then(done)
"""


def files(spark):
    return spark.createDataFrame([(1, SOURCE), (2, None), (3, ""), (4, "f(")], "file_id long, content string")


def test_calls(spark):
    rows = calls.source_calls(files(spark)).collect()
    got = sorted((r.start_row, r.callee, r.argument_list, r.caller, r.end_row) for r in rows)
    want = [
        (5, "require", "('old-lib')", "", 5),
        (9, "make", "(1)", "A", 9),
        (13, "check", "(list)", "run", 13),
        (13, "make", "(q)", "q", 13),
        (13, "ns.deep.call", "(list, q => { return make(q) })", "run", 13),
        (14, "other", "(`(${t})`)", "run", 14),
        (15, ".test", "(t)", "run", 15),
        (19, "fallback", "()", "inner", 19),
        (20, "helper", "(\n      a\n    )", "inner", 22),
        (24, "inner", "(1)", "helper", 24),
        (24, "inner", "(2)", "helper", 24),
        (25, ".chain", "()", "helper", 25),
        (25, "Thing", "()", "helper", 25),
        (29, "helper", "(x => x)", "", 29),
        (30, ".then", "(done)", "", 30),
    ]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)], got
    assert got == sorted(want)


def test_imports(spark):
    rows = calls.source_imports(files(spark)).collect()
    assert sorted((r.module, r.name, r.alias) for r in rows) == sorted([
        ("@lib/parts.core", "make_part", "make"), ("@lib/parts.core", "other", "other"), ("@lib/parts.core", "Kind", "Kind"),
        ("tools", "default", "def"), ("tools", "*", "ns"), ("fs", "default", "fs"), ("side-effect", "", ""), ("./again", "again", "again"),
        ("old-lib", "", ""), ("lazy", "", ""),
    ])


def test_where_calls_lead(spark):
    table = files(spark)
    rows = calls.resolved_calls(calls.source_calls(table), calls.source_imports(table), extract.extract_functions(table)).collect()
    got = {r.callee: (r.origin, r.module, r.name) for r in rows}
    assert got["make"] == ("imported", "@lib/parts.core", "make_part")
    assert got["ns.deep.call"] == ("imported", "tools", "call")
    assert got["helper"] == ("local", None, None)
    assert got["check"] == got[".test"] == ("other", None, None)


def test_nothing_made_of_texts_is_broadcast(spark, tmp_path):
    """The planner takes texts made by a query for as small as the files they are made from."""
    files(spark).write.parquet(f"{tmp_path}/files")
    few = spark.read.parquet(f"{tmp_path}/files")
    out = calls.resolved_calls(calls.source_calls(few), calls.source_imports(few), extract.extract_functions(few))
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
