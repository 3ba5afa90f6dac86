"""Text and lookup expressions."""

from functools import reduce

from pyspark.sql import Column, functions as F

from turnout.functions.clock import _col
from turnout.schema import CODE_TO_TYPE, UNKNOWN_TYPE


def normalized_text(c) -> Column:
    return F.upper(F.trim(_col(c)))


def code_prefix(c, length: int = 2) -> Column:
    return F.substring(_col(c), 1, length)


def map_code(c, mapping=None, default: str = UNKNOWN_TYPE) -> Column:
    """Label of a code from a small fixed mapping, ``default`` where there is none.

    The mapping is folded into the plan as a CASE, so no join and no shuffle.
    """
    code = _col(c)
    mapping = CODE_TO_TYPE if mapping is None else mapping
    if not mapping:
        return F.lit(default)
    (first, label), *rest = mapping.items()
    case = reduce(
        lambda chain, item: chain.when(code == item[0], item[1]),
        rest,
        F.when(code == first, label),
    )
    return case.otherwise(default)


def pair_label(a, b) -> Column:
    """``a | b``, null if either part is null."""
    return F.concat(_col(a), F.lit(" | "), _col(b))


def is_blank(c) -> Column:
    return _col(c).isNull() | (F.trim(_col(c)) == "")
