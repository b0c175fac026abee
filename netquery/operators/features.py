"""Feature engineering: one-hot (FE1), train-schema alignment (PR4, PR5),
numeric-column choice (PR6), std scaling without/with centring (FE2, FE3),
vector assembly (FE4) and forest feature importances (FE5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def categories(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Distinct values per categorical column in one aggregate: collect_set
    combines map-side, so each task holds at most the columns' cardinality
    and nothing data-sized is shuffled; the list becomes part of the fitted
    encoding."""
    row = df.agg(*[F.collect_set(F.col(c).cast("string")).alias(c) for c in cols]).first()
    return {c: sorted(v for v in (row[c] or []) if v is not None) for c in cols}


def dummy_name(col: str, value: str) -> str:
    return f"{col}_{value}"


def one_hot(df: DataFrame, cols: list[str], cats: dict[str, list[str]], drop: bool = True) -> DataFrame:
    """FE1 (wide form): 0/1 column `<col>_<value>` per known category; a value
    not in `cats` (seen only at test time) or null gives all zeros."""
    extra = [F.when(F.col(c).cast("string") == F.lit(v), 1).otherwise(0).cast("int").alias(dummy_name(c, v))
             for c in cols for v in cats.get(c, [])]
    keep = [x for x in df.columns if not (drop and x in cols)]
    return df.select(*keep, *extra)


def set_dummies(wide: DataFrame, cols: list[str], cats: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """FE1 (long form) of the wide one: (keep..., feature) for each dummy that is 1. A row has one dummy of a column
    at most, so it has an entry for each column of `cols`, however many categories these have."""
    def named(c):
        names = [dummy_name(c, v) for v in cats.get(c, [])]
        return F.coalesce(F.lit(None).cast("string"), *[F.when(F.col(f"`{n}`") == 1, F.lit(n)) for n in names])
    return wide.select(*keep, F.explode(F.array(*[named(c) for c in cols])).alias("feature")).where(F.col("feature").isNotNull())


def align_to(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """PR4: the train column list in train order; missing -> fill, extra dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in columns])


def align_common(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PR5: keep only the columns present on both sides (sorted, deterministic)."""
    common = sorted(set(a.columns) & set(b.columns))
    return a.select(*common), b.select(*common)


def numeric_columns(df: DataFrame, exclude_prefixes=(), require_binary_for_exclusion: bool = False) -> list[str]:
    """PR6: numeric columns minus dummy columns (by prefix). With the stricter
    variant a prefixed column is excluded only if its content is all 0/1,
    checked in one aggregate pass."""
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte", "decimal")]
    pref = [c for c in num if any(c.startswith(p) for p in exclude_prefixes)]
    if not require_binary_for_exclusion or not pref:
        return [c for c in num if c not in pref]
    row = df.agg(*[F.max(~F.col(c).isin(0, 1)).alias(c) for c in pref]).first()
    binary = {c for c in pref if not row[c]}
    return [c for c in num if c not in binary]


def numeric_column_rules(df: DataFrame, exclude_prefixes=()) -> DataFrame:
    """PR6 as rows: every numeric column of `df`, whether its name starts with a dummy
    prefix, whether it holds a value other than 0 and 1, and whether it stays by the prefix
    alone and by the stricter rule (prefix and 0/1 content). One aggregate pass with map-side
    combine over all rows; the result has a row for each column. Columns that are empty or all null hold
    no other value."""
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte", "decimal")]
    other = df.agg(*[F.coalesce(F.max(~F.col(f"`{c}`").isin(0, 1)), F.lit(False)).alias(f"o{i}") for i, c in enumerate(num)])
    each = [F.struct(F.lit(c).alias("column"), F.lit(any(c.startswith(p) for p in exclude_prefixes)).alias("prefixed"), F.col(f"o{i}").alias("other_values"))
            for i, c in enumerate(num)]
    return (other.select(F.inline(F.array(*each)))
            .withColumns({"by_prefix": ~F.col("prefixed"), "by_prefix_and_binary": ~F.col("prefixed") | F.col("other_values")}))


def scale_fit(df: DataFrame, cols: list[str], with_mean: bool = False) -> dict[str, tuple[float, float]]:
    """FE2/FE3 fit: population std (and mean) per column in one aggregate pass;
    a zero-variance column keeps scale 1, as the reference library does."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    out = {}
    for c in cols:
        s = row[f"s_{c}"]
        out[c] = (float(row[f"m_{c}"] or 0.0) if with_mean else 0.0, float(s) if s not in (None, 0.0) else 1.0)
    return out


def scale_apply(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """FE2/FE3 transform: (x - mean) / std with the train parameters."""
    return df.select(*[((F.col(c).cast("double") - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c)
                       if c in params else F.col(c) for c in df.columns])


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """FE4: vector column (sparse where mostly zero)."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def ml_one_hot_stages(cols: list[str]):
    """FE1 (ML form): StringIndexer(alphabetAsc, keep) + OneHotEncoder(dropLast):
    an unseen category gets the all-zero vector of the train width."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols],
                        dropLast=True, handleInvalid="keep")
    return [idx, ohe]


def feature_importance(model, names: list[str], spark=None) -> DataFrame:
    """FE5: (feature, importance) rows from a fitted tree ensemble (one value
    per feature: bounded by the feature count)."""
    spark = spark or __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")
