"""Feature-engineering queries on connection records (PR4-PR6, FE1-FE4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models.own import materialised
from ..operators import features as FE
from ..sources.readers import CATEGORICAL_COLUMNS, FEATURE_COLUMNS
from .derived import CONNECTION_SQL, connection_records
from .registry import query, rnd

# Category values the derivation can produce (used only to write the SQL twin;
# the Spark side discovers its categories from the train rows).
_SQL_CATS = {
    "protocol_type": ["icmp", "tcp", "udp"],
    "service": ["high", "low", "medium", "not_specified", "urgent", "x11"],
    "flag": ["REJ", "S0", "SF"],
}
# the numeric columns that the derivation fills, and one that is constant; all others are constant 0 too
NUMERIC = ["duration", "src_bytes", "dst_bytes", "hot", "logged_in", "count", "srv_count", "serror_rate", "rerror_rate",
           "same_srv_rate", "dst_host_count", "land"]


def split_frames(spark, sf):
    c = connection_records(spark, sf)
    return c.where(F.col("split") == "train"), c.where(F.col("split") == "test")


def train_columns(train):
    cats = FE.categories(train, CATEGORICAL_COLUMNS)
    return cats, [FE.dummy_name(c, v) for c in CATEGORICAL_COLUMNS for v in cats[c]]


def _sql_dummies():
    out = []
    for c in CATEGORICAL_COLUMNS:
        for v in _SQL_CATS[c]:
            out.append((c, v))
    return out


def _dummy_sql(skip=()):
    return ", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\""
                     for c, v in _sql_dummies() if v not in skip)


def _train_cats_sql():
    # categories present in train, computed in SQL
    return f"tc AS (SELECT DISTINCT 'protocol_type' AS c, protocol_type AS v FROM ({CONNECTION_SQL}) WHERE split = 'train' " \
           f"UNION SELECT DISTINCT 'service', service FROM ({CONNECTION_SQL}) WHERE split = 'train' " \
           f"UNION SELECT DISTINCT 'flag', flag FROM ({CONNECTION_SQL}) WHERE split = 'train')"


@query("one_hot_long", oracle=f"""
WITH {_train_cats_sql()}, t AS ({CONNECTION_SQL})
SELECT t.conn_id, tc.c || '_' || tc.v AS feature
FROM t JOIN tc ON (tc.c = 'protocol_type' AND t.protocol_type = tc.v) OR (tc.c = 'service' AND t.service = tc.v)
             OR (tc.c = 'flag' AND t.flag = tc.v)""")
def q_one_hot_long(spark, sf):
    """FE1 with train categories applied to train and test rows, reported as the
    (row, feature) pairs whose dummy is 1 (test-only values give none)."""
    rows = materialised(connection_records(spark, sf).select("conn_id", "split", *CATEGORICAL_COLUMNS), "records")
    cats, _ = train_columns(rows.where("split = 'train'"))
    w = FE.one_hot(rows.select("conn_id", *CATEGORICAL_COLUMNS), CATEGORICAL_COLUMNS, cats)
    return FE.set_dummies(w, CATEGORICAL_COLUMNS, cats, ["conn_id"])


@query("align_to_train", oracle=f"""
WITH t AS ({CONNECTION_SQL})
SELECT conn_id, {_dummy_sql(("x11",))}
FROM t WHERE split = 'test'""")
def q_align_to_train(spark, sf):
    """PR4: test one-hot from the test's own categories, aligned to the train
    column list (train-only dummies filled with 0, test-only dropped)."""
    train, test = split_frames(spark, sf)
    _, cols = train_columns(train)
    tcats = FE.categories(test, CATEGORICAL_COLUMNS)
    w = FE.one_hot(test.select("conn_id", *CATEGORICAL_COLUMNS), CATEGORICAL_COLUMNS, tcats)
    return FE.align_to(w, ["conn_id", *cols])


@query("align_common", oracle=f"""
WITH t AS ({CONNECTION_SQL})
SELECT conn_id, {_dummy_sql(("x11", "REJ"))}
FROM t WHERE split = 'test'""")
def q_align_common(spark, sf):
    """PR5: keep only the dummy columns present on both sides."""
    train, test = split_frames(spark, sf)
    a = FE.one_hot(train.select("conn_id", *CATEGORICAL_COLUMNS), CATEGORICAL_COLUMNS,
                   FE.categories(train, CATEGORICAL_COLUMNS))
    b = FE.one_hot(test.select("conn_id", *CATEGORICAL_COLUMNS), CATEGORICAL_COLUMNS,
                   FE.categories(test, CATEGORICAL_COLUMNS))
    _, bb = FE.align_common(a, b)
    return bb


_ALL_NUMERIC = [c for c in FEATURE_COLUMNS if c not in CATEGORICAL_COLUMNS]
_PREFIXES = ("protocol_type_", "service_", "flag_", "dst_host_")


def _numeric_columns_sql():
    # columns that the derivation does not fill are 0
    content = " UNION ALL ".join(f"SELECT '{c}' AS col, coalesce(bool_or({c if c in NUMERIC else 0} NOT IN (0, 1)), false) AS other_values FROM r" for c in _ALL_NUMERIC)
    prefixed = " OR ".join(f"starts_with(col, '{p}')" for p in _PREFIXES)
    return f"""
WITH {_train_cats_sql()}, r AS (SELECT * FROM ({CONNECTION_SQL}) WHERE split = 'train'),
x AS ({content} UNION ALL SELECT c || '_' || v, false FROM tc)
SELECT col AS "column", {prefixed} AS prefixed, other_values, NOT ({prefixed}) AS by_prefix,
       NOT ({prefixed}) OR other_values AS by_prefix_and_binary FROM x"""


@query("numeric_columns", oracle=_numeric_columns_sql())
def q_numeric_columns(spark, sf):
    """PR6: numeric feature columns of the encoded train frame by both variants. Besides the
    dummies' prefixes `dst_host_` counts as one, so the variants differ by a column
    that only looks like a dummy."""
    train, _ = split_frames(spark, sf)
    cats, _ = train_columns(train)
    w = FE.one_hot(train.drop("split", "attack", "difficulty"), CATEGORICAL_COLUMNS, cats)
    return FE.numeric_column_rules(w, _PREFIXES)


def _scale_sql(with_mean: bool):
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC)
    cols = ", ".join(
        f"round(({c} - {'m_' + c if with_mean else '0'}) / (CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1 ELSE s_{c} END), 6) AS {c}"
        for c in NUMERIC)
    return f"""
WITH t AS ({CONNECTION_SQL}), st AS (SELECT {stats} FROM t WHERE split = 'train')
SELECT conn_id, {cols} FROM t, st"""


def _scaled(spark, sf, with_mean):
    rows = connection_records(spark, sf)
    params = FE.scale_fit(rows.where("split = 'train'"), NUMERIC, with_mean=with_mean)
    s = FE.scale_apply(rows.select("conn_id", *NUMERIC), params)
    return s.select("conn_id", *[rnd(c).alias(c) for c in NUMERIC])


@query("scale_no_mean", oracle=_scale_sql(False))
def q_scale_no_mean(spark, sf):
    """FE2: x / std_pop(train x); zero-variance columns keep scale 1."""
    return _scaled(spark, sf, False)


@query("scale_with_mean", oracle=_scale_sql(True))
def q_scale_with_mean(spark, sf):
    """FE3: (x - mean) / std_pop, train parameters."""
    return _scaled(spark, sf, True)


@query("assemble_vector", oracle=f"""
WITH t AS ({CONNECTION_SQL})
SELECT conn_id, {len(NUMERIC)} AS size, round({" + ".join(f"CAST({c} AS DOUBLE)" for c in NUMERIC)}, 6) AS total
FROM t""")
def q_assemble_vector(spark, sf):
    """FE4: VectorAssembler over the numeric columns; size and element sum."""
    from pyspark.ml.functions import vector_to_array
    v = FE.assemble(connection_records(spark, sf).select("conn_id", *NUMERIC), NUMERIC)
    arr = vector_to_array("features")
    return v.select("conn_id", F.size(arr).alias("size"),
                    rnd(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)).alias("total"))
