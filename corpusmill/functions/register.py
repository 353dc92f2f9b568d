"""The engine's functions under SQL names.

Those without lambdas become SQL functions whose body is the native expression, which Spark inlines. The others can
be had as columns of a view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language as L
from . import status as S
from . import text as T
from . import url as U

#: Name, argument types, result type and expression.
FUNCTIONS: dict[str, tuple[list[str], str, object]] = {
    "url_domain": (["STRING"], "STRING", U.domain),
    "url_date": (["STRING"], "DATE", U.url_date),
    "normalize_text": (["STRING"], "STRING", T.normalize_text),
    "content_hash": (["STRING"], "STRING", T.content_hash),
    "token_count": (["STRING"], "INT", T.token_count),
    "is_quote": (["STRING"], "BOOLEAN", T.is_quote),
    "quality_reason": (["STRING"], "STRING", T.quality_reason),
    "parse_date": (["STRING"], "TIMESTAMP_NTZ", S._parsed),
    "http_category": (["INT"], "STRING", S.http_category),
    "hamming64": (["BIGINT", "BIGINT"], "INT", T.hamming),
}
#: Functions of a text that need lambdas.
COLUMNS = {"normalize_url": U.normalize_url, "segment_sentences": T.sentences, "detect_language": L.detect}


def _body(spark: SparkSession, arguments: list[str], expression) -> str:
    """The analysed expression as SQL over x0, x1, ..."""
    names = [f"x{i}" for i in range(len(arguments))]
    row = spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {t}) AS {n}" for t, n in zip(arguments, names, strict=True)))
    column: Column = expression(*map(F.col, names))
    analysed = row.select(column.alias("y"))._jdf.queryExecution().analyzed().expressions().head().child()
    return analysed.sql()


def register(spark: SparkSession) -> list[str]:
    """Make FUNCTIONS callable from SQL in this session; their names."""
    for name, (arguments, result, expression) in FUNCTIONS.items():
        given = ", ".join(f"x{i} {t}" for i, t in enumerate(arguments))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS {result} RETURN CAST({_body(spark, arguments, expression)} AS {result})")
    return sorted(FUNCTIONS)


def view(df: DataFrame, name: str, column: str = "text") -> None:
    """A view of df with the functions of COLUMNS as columns, which are evaluated only where a query selects them."""
    df.select("*", *[f(F.col(column)).alias(k) for k, f in COLUMNS.items()]).createOrReplaceTempView(name)
