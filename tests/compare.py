"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import math


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "∅" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def rows_of(tbl):
    cols = sorted(tbl.column_names)
    data = {c: tbl.column(c).to_pylist() for c in cols}
    return cols, sorted("|".join(_norm(data[c][r]) for c in cols) for r in range(tbl.num_rows))


def same_result(spark_tbl, duck_tbl):
    cs, rs = rows_of(spark_tbl)
    cd, rd = rows_of(duck_tbl)
    assert cs == cd, (cs, cd)
    assert len(rs) == len(rd), (len(rs), len(rd))
    diff = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
    assert not diff, diff
