"""Feature registry.

A feature function takes an accessor ``c`` (attribute access to prepared input
columns) and returns a ``Column``: an aggregate expression when the feature is
computed per group, a row expression otherwise.  Decorators attach the declared
output schema, and ``FeatureSet`` evaluates every function of every group in
**one** ``select``/``agg`` so Catalyst sees all expressions at once.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Mapping, Sequence
from types import ModuleType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TYPE_NAMES = {
    float: "double", int: "bigint", str: "string", bool: "boolean",
    "float": "double", "float64": "double", "double": "double",
    "int": "bigint", "int64": "bigint", "Int64": "bigint", "bigint": "bigint", "long": "bigint",
    "str": "string", "string": "string", "object": "string", "category": "string",
    "bool": "boolean", "boolean": "boolean",
    "datetime64[ns]": "timestamp", "timestamp": "timestamp", "date": "date",
}


def spark_type(dtype) -> str:
    """map a declared dtype (Python type or pandas/Spark name) to a Spark type."""
    try:
        return _TYPE_NAMES[dtype]
    except (KeyError, TypeError):
        raise TypeError(f"unsupported dtype {dtype!r}") from None


def _validate(specs) -> list[tuple[str, str]]:
    if not isinstance(specs, (list, tuple)) or not specs:
        raise ValueError("feature specs must be a non-empty list of (name, dtype) pairs")
    out = []
    for spec in specs:
        if not isinstance(spec, (list, tuple)) or len(spec) != 2:
            raise ValueError(f"feature spec {spec!r} must be a (name, dtype) pair")
        name, dtype = spec
        if not isinstance(name, str):
            raise TypeError(f"feature name {name!r} must be a str")
        if not isinstance(dtype, (type, str)):
            raise TypeError(f"dtype of {name!r} must be a type or a str")
        out.append((name, spark_type(dtype)))
    return out


def features(specs: Sequence[tuple[str, object]], kind: str = "native", stage: str = "agg",
             inputs: Sequence[str] = ()):
    """declare a function producing several columns (returns a list/tuple).

    ``stage="agg"`` features are aggregate expressions over the group's rows;
    ``stage="post"`` ones are row expressions over the aggregated frame (for
    features built on other aggregates, such as a mode or a flag of it).
    """
    schema = _validate(specs)
    if kind not in ("native", "pandas"):
        raise ValueError("kind must be 'native' or 'pandas'")
    if stage not in ("agg", "post"):
        raise ValueError("stage must be 'agg' or 'post'")

    if kind == "pandas" and not inputs:
        raise ValueError("pandas features must name their input columns")

    def wrap(fn: Callable):
        fn.schema = schema
        fn.kind = kind
        fn.stage = stage
        fn.inputs = tuple(inputs)
        return fn

    return wrap


def feature(name: str, dtype, kind: str = "native", stage: str = "agg", inputs: Sequence[str] = ()):
    """declare a single-column feature.  ``kind="pandas"``: the function
    takes pandas Series of ``inputs`` and returns a Series; it runs as an
    Arrow-batched ``pandas_udf`` (row stage only)."""
    return features([(name, dtype)], kind=kind, stage=stage, inputs=inputs)


def group_apply(df: DataFrame, keys: Sequence[str], fn: Callable, schema: str, per_group_udf: bool = False) -> DataFrame:
    """a per-group callable returning rows (pandas ``groupby.apply``);
    ``fn`` returns a DataFrame or, cheaper, a mapping for a single row.

    Default: the rows are hash-partitioned by ``keys`` and sorted, and one
    ``mapInPandas`` call per Arrow batch applies ``fn`` to every group in the
    batch (a group cut by a batch boundary is carried into the next batch).
    This avoids one JVM/Python round trip per group, which dominates when
    groups are many and small.  ``per_group_udf=True`` uses
    ``groupBy().applyInPandas``.  Either way a group must fit in one worker:
    use it for groups of bounded size (for example one entity's periods).
    """
    keys = list(keys)

    def frame(results):
        import pandas as pd

        rows = [r for r in results if isinstance(r, Mapping)]
        frames = [r for r in results if not isinstance(r, Mapping)]
        if rows:
            frames.append(pd.DataFrame(rows))
        return pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]

    if per_group_udf:
        return df.groupBy(*keys).applyInPandas(lambda g: frame([fn(g)]), schema=schema)

    def run(batches):
        import pandas as pd

        carry = None
        for pdf in batches:
            if carry is not None and len(carry):
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if pdf.empty:
                continue
            last = pdf.iloc[-1][keys]
            tail = (pdf[keys] == last.values).all(axis=1) | pdf[keys].isna().all(axis=1) & last.isna().all()
            carry, body = pdf[tail], pdf[~tail]
            if len(body):
                yield frame([fn(g) for _, g in body.groupby(keys, sort=False, dropna=False)])
        if carry is not None and len(carry):
            yield frame([fn(g) for _, g in carry.groupby(keys, sort=False, dropna=False)])

    parted = df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return parted.mapInPandas(run, schema=schema)


def features_of(module: ModuleType) -> list[Callable]:
    """feature functions defined in ``module`` itself, sorted by function name."""
    found = [
        fn for fname, fn in inspect.getmembers(module, inspect.isfunction)
        if getattr(fn, "schema", None) is not None and fn.__module__ == module.__name__
    ]
    return sorted(found, key=lambda f: f.__name__)


class Cols:
    """Attribute access to prepared columns: ``c.points`` -> ``F.col("points")``."""

    def __init__(self, df: DataFrame | None = None):
        self._names = set(df.columns) if df is not None else None

    def __getattr__(self, name: str) -> Column:
        if name.startswith("__"):
            raise AttributeError(name)
        if self._names is not None and name not in self._names:
            raise AttributeError(f"no input column {name!r}")
        return F.col(name)


def _columns(fn: Callable, c: Cols) -> list[Column]:
    if getattr(fn, "kind", "native") == "pandas":
        from pyspark.sql.functions import pandas_udf

        (name, dtype), = fn.schema
        udf = pandas_udf(fn, returnType=dtype)
        return [udf(*[F.col(i) for i in fn.inputs]).alias(name)]
    out = fn(c)
    cols = list(out) if isinstance(out, (list, tuple)) else [out]
    if len(cols) != len(fn.schema):
        raise ValueError(f"{fn.__name__} returned {len(cols)} columns for {len(fn.schema)} declared")
    return [col.cast(t).alias(n) for col, (n, t) in zip(cols, fn.schema)]


class FeatureSet:
    """evaluate groups of feature functions over one DataFrame.

    ``transform(df, keys)`` groups by ``keys`` (aggregate features) or, with
    ``keys=None``, projects row by row.  With one group it returns one
    DataFrame; with several a tuple, one per group, all from the same plan.
    """

    def __init__(self, *groups: Iterable[Callable]):
        if not groups:
            raise ValueError("at least one group of features is required")
        self.groups = [list(g) for g in groups]
        for g in self.groups:
            for fn in g:
                if getattr(fn, "schema", None) is None:
                    raise TypeError(f"{fn!r} is not a declared feature")

    def schema(self) -> list[list[tuple[str, str]]]:
        return [[s for fn in g for s in fn.schema] for g in self.groups]

    def columns(self, df: DataFrame, group: int = 0) -> list[Column]:
        c = Cols(df)
        return [col for fn in self.groups[group] for col in _columns(fn, c)]

    def transform(self, df: DataFrame, keys: Sequence[str] | None = None):
        outs = []
        for i in range(len(self.groups)):
            cols = self.columns(df, i)
            if keys:
                outs.append(df.groupBy(*keys).agg(*cols))
            else:
                outs.append(df.select(*cols))
        return outs[0] if len(outs) == 1 else tuple(outs)

    def to_matrix(self, df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """raw values per group as one struct column per group (row mode), each value of its own type."""
        cols = [F.struct(*self.columns(df, i)).alias(f"group_{i}") for i in range(len(self.groups))]
        return df.select(*(keys or []), *cols)
