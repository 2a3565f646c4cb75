def rows(df):
    """All rows as tuples in a fixed order, nulls first."""
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda r: [(v is not None, str(type(v)), v) if v is not None else (False,)
                                 for v in r])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return sum("Exchange hashpartitioning" in line for line in plan(df).splitlines())
