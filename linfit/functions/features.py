"""Row-wise feature preparation: casts, tokenising, assembling, slicing, expanding."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.functions.vectors import doubles


def _named(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def column(name: str) -> Column:
    """A column by its exact name, also where the name holds dots, plus signs or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_double(text: Column | str) -> Column:
    """String to double where every failure, a null included, becomes 0.0."""
    return F.coalesce(_named(text).try_cast("double"), F.lit(0.0))


def cast_label(label: Column | str) -> Column:
    return _named(label).cast("int")


def fill_numeric(df: DataFrame, value: float = 0.0) -> DataFrame:
    """Nulls of numeric columns become ``value``; strings keep theirs."""
    return df.na.fill(value)


def tokenize(line: Column | str, delimiter: str = ",", arity: int | None = None) -> Column:
    """Split a line at every delimiter, keeping empty fields so that positions never shift.

    With ``arity`` a line with another number of fields raises.
    """
    line = _named(line)
    parts = F.split(line, _literal_pattern(delimiter), -1)
    if arity is None:
        return parts
    message = F.concat_ws(
        " ", F.lit(f"expected {arity} fields, got"), F.size(parts).cast("string")
    )
    return F.when(F.size(parts) == arity, parts).otherwise(F.raise_error(message))


def _literal_pattern(delimiter: str) -> str:
    return "\\Q" + delimiter + "\\E"


def array_to_features(
    parts: Column | str, element: Callable[[Column], Column] | None = None
) -> Column:
    """array<string> to array<double>, one column function per element.

    The default turns an unreadable element into null; pass ``safe_double`` for 0.0 instead.
    """
    if element is None:  # a cast ignores blanks around a number, and is compiled
        return _named(parts).try_cast("array<double>")
    return F.transform(_named(parts), element)


def features_to_array(
    features: Column | str, element: Callable[[Column], Column] | None = None
) -> Column:
    """array<double> to array<double> through a per-element column function."""
    features = _named(features)
    return F.transform(features, element) if element else features


def feature_element(features: Column | str, index: int) -> Column:
    return F.get(_named(features), F.lit(index))


def slice_features(features: Column | str, indices: Sequence[int]) -> Column:
    """Elements at ``indices``, in that order; a contiguous run becomes one native slice."""
    features, wanted = _named(features), list(indices)
    if not wanted:
        raise ValueError("slice_features needs at least one index")
    if wanted == list(range(wanted[0], wanted[0] + len(wanted))):
        return F.slice(features, wanted[0] + 1, len(wanted))
    return F.array(*[F.get(features, F.lit(i)) for i in wanted])


def assemble(*parts: Column | str | Sequence[str], arrays: Sequence[str] = ()) -> Column:
    """Numeric columns, then whole array columns, as one array<double>."""
    numeric: list[Column] = []
    for part in parts:
        if isinstance(part, str):
            numeric.append(column(part).cast("double"))
        elif isinstance(part, Column):
            numeric.append(part.cast("double"))
        else:
            numeric.extend(column(name).cast("double") for name in part)
    pieces = ([F.array(*numeric)] if numeric else []) + [doubles(column(a)) for a in arrays]
    if not pieces:
        raise ValueError("assemble needs at least one column")
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def with_bias(features: Column | str) -> Column:
    """A constant 1.0 behind the last feature."""
    return F.concat(_named(features), F.array(F.lit(1.0)))


@lru_cache(maxsize=64)
def monomials(width: int, degree: int) -> tuple[tuple[int, ...], ...]:
    """Every product of at most ``degree`` of ``width`` inputs, as tuples of input positions.

    The order is the one of ``pyspark.ml.feature.PolynomialExpansion``: all terms without the
    last input, then those with its first power, its second power, and so on.
    """
    if width < 1 or degree < 1:
        raise ValueError("width and degree must be at least 1")

    def terms(inputs: int, budget: int) -> list[tuple[int, ...]]:
        if inputs == 0:
            return [()]
        return [
            term + (inputs - 1,) * power
            for power in range(budget + 1)
            for term in terms(inputs - 1, budget - power)
        ]

    return tuple(t for t in terms(width, degree) if t)


def polynomial(features: Column | str, width: int, degree: int) -> Column:
    """Polynomial expansion of an array of known width; degree 1 is the array itself."""
    features = _named(features)
    if degree == 1:
        return features
    x = [F.get(features, F.lit(i)) for i in range(width)]
    return F.array(
        *[reduce(lambda a, b: a * b, [x[i] for i in term]) for term in monomials(width, degree)]
    )


def append_polynomials(
    df: DataFrame, features: str, width: int, degrees: Sequence[int], prefix: str
) -> DataFrame:
    """One more column ``prefix<degree>`` for every degree above 1."""
    return df.withColumns(
        {f"{prefix}{d}": polynomial(features, width, d) for d in dict.fromkeys(degrees) if d != 1}
    )
