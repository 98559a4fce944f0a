"""Property tests (no Spark): the safe evaluator agrees with Python's own
arithmetic on the expressions the reward accepts."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tokenmill.operators.rewards import evaluate_arithmetic

ints = st.integers(min_value=0, max_value=999).map(str)


def _expr(children):
    op = st.sampled_from(["+", "-", "*", "/", "//"])
    return st.one_of(
        st.tuples(children, op, children).map(lambda t: f"{t[0]} {t[1]} {t[2]}"),
        children.map(lambda e: f"({e})"),
        children.map(lambda e: f"-{e}"),
    )


expressions = st.recursive(ints, _expr, max_leaves=8)


def _python_value(e):
    try:
        v = float(eval(e, {"__builtins__": None}, {}))  # reference semantics, test oracle only
        return v if math.isfinite(v) else None
    except Exception:
        return None


@settings(max_examples=400, deadline=None)
@given(expressions)
def test_evaluator_matches_python(e):
    want = _python_value(e)
    got = evaluate_arithmetic(e)
    if want is None:
        assert got is None
    else:
        assert got is not None and math.isclose(got, want, rel_tol=1e-12, abs_tol=1e-12)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="0123456789+-*/(). _ax=", max_size=30))
def test_evaluator_never_raises(s):
    v = evaluate_arithmetic(s)
    assert v is None or math.isfinite(v)
