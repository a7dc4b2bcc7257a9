"""Reading physical plans in tests."""

import re


def executed(df) -> str:
    """The physical plan before adaptive execution, without running it."""
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", executed(df)))


def runs_python(df) -> bool:
    return bool(re.search(r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas)", executed(df)))
