"""Fixtures over the driver's tables: one SQL text for Spark and for the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("documents", "part", "embeddings", "lineitem", "events")
_TOKENS = {
    "spark": {"$DIV": "div", "$POSEXPLODE": "SELECT vec_id, label, posexplode(embedding) AS (p, e) FROM embeddings"},
    "duckdb": {"$DIV": "//", "$POSEXPLODE": "SELECT vec_id, label, unnest(range(0, 64)) AS p, unnest(embedding) AS e FROM embeddings"},
}
_SEQ = {"spark": r"explode(sequence(0, \1 - 1))", "duckdb": r"unnest(range(0, \1))"}

SQL = {
    "paths": """
SELECT doc_id AS image_id, 'image' AS role, d AS split,
       'data/' || d || '/img_' || lpad(cast(doc_id AS string), 8, '0') || '.' ||
       CASE WHEN doc_id % 41 = 0 THEN 'txt' WHEN doc_id % 37 = 0 THEN 'JPG'
            WHEN doc_id % 4 < 2 THEN 'jpg' WHEN doc_id % 4 = 2 THEN 'png' ELSE 'jpeg' END AS path
FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'test' ELSE 'train' END AS d FROM documents) a
UNION ALL
SELECT doc_id, 'mask', d, 'data/' || d || '_masks/img_' || lpad(cast(doc_id AS string), 8, '0') || '.png'
FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'test' ELSE 'train' END AS d FROM documents WHERE doc_id % 29 <> 0) b""",
    "plots": """
SELECT p_partkey AS image_id, 16 + p_size % 17 AS width, 16 + cast(p_partkey % 13 AS int) AS height,
       cast(p_partkey % 11 AS int) + 3 AS cx, cast(p_partkey % 7 AS int) + 4 AS cy,
       CASE WHEN p_size % 10 = 0 THEN -1 ELSE p_size % 6 END AS r
FROM part""",
    "mask_pixels": """
SELECT image_id, width, height, cast(y AS int) AS y, cast(x AS int) AS x,
       CASE WHEN r >= 0 AND (x-cx)*(x-cx) + (y-cy)*(y-cy) <= r*r THEN 0 ELSE 255 END AS v
FROM (SELECT *, $SEQ(width) AS x FROM (SELECT *, $SEQ(height) AS y FROM plots) g) h""",
    "rgb_pixels": """
SELECT image_id, width, height, y, x, cast(c AS int) AS c,
       cast((image_id*31 + y*17 + x*7 + c*53) % 256 AS int) AS v
FROM (SELECT *, $SEQ(3) AS c FROM mask_pixels) m""",
    "raster8": """
SELECT vec_id AS image_id, label, cast(p $DIV 8 AS int) AS y, cast(p % 8 AS int) AS x, cast(e AS double) AS logit,
       CASE WHEN cast(e AS double) + 0.05*((vec_id + p) % 5 - 2) > 0 THEN 1 ELSE 0 END AS target,
       cast(floor(least(greatest((cast(e AS double) + 0.6)/1.2, 0.0), 1.0)*255) AS int) AS v
FROM ($POSEXPLODE) t""",
    "epoch_scores": """
SELECT cast(k AS int) + 1 AS epoch, image_id, y, x,
       logit*(1 + k) + (1 - target*2)*0.1*(1 - k*0.5) AS logit, target,
       CASE WHEN image_id % 5 = 4 THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, $SEQ(3) AS k FROM raster8) r""",
    "line_pixels": """
SELECT l_orderkey AS image_id, (l_discount - 0.045)*100 AS logit,
       CASE WHEN l_tax > 0.035 THEN 1 ELSE 0 END AS target
FROM lineitem""",
    "detections": """
SELECT l_orderkey AS image_id, l_quantity*10 + 0.7 AS x_min, l_tax*1000 + 0.3 AS y_min,
       l_quantity*10 + 0.7 + l_extendedprice/100 AS x_max, l_tax*1000 + 0.3 + l_extendedprice/200 AS y_max,
       l_discount*10 AS conf, l_partkey AS k1, l_suppkey AS k2, l_linenumber AS k3
FROM lineitem WHERE l_linestatus = 'F'""",
    "frames_dim": """
SELECT p_partkey AS image_id, 900 + p_size*150 AS width, 900 + cast(p_partkey % 50 AS int)*150 AS height
FROM part""",
    "runs": """
SELECT DISTINCT CASE WHEN event_id % 7 = 0 THEN 'run-' || cast(event_id AS string)
                     WHEN event_id % 11 = 0 THEN event_type || '_weights'
                     ELSE event_type || '_' || substring(cast(ts AS string), 1, 10) END AS folder
FROM events""",
    "epoch_metrics": """
SELECT event_id, substring(cast(ts AS string), 1, 10) AS run_date, cast(event_id % 10 AS int) + 1 AS epoch,
       value/100 AS train_loss, value/128 AS val_loss
FROM events""",
}


def _text(name: str, dialect: str) -> str:
    sql = re.sub(r"\$SEQ\(([^)]*)\)", _SEQ[dialect], SQL[name])
    for token, text in _TOKENS[dialect].items():
        sql = sql.replace(token, text)
    return sql


def needs(name: str) -> list[str]:
    """The fixtures and tables that a text names."""
    sql = _text(name, "spark")
    return [n for n in (*TABLES, *SQL) if n != name and re.search(rf"\bFROM {n}\b", sql)]


#: What is made long by a fixture, and the bytes of it that a task gets: a small file is one task, but hundreds of pixels a row.
_LONG = {"mask_pixels": ("plots", 1 << 14), "raster8": ("embeddings", 1 << 22)}


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """The rows in tasks of about so many bytes, and at least one for each core."""
    guess = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-guess // size)))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    given = {n: fixture(spark, sf_dir, n) for n in needs(name)}
    if name in _LONG:
        table, size = _LONG[name]
        given[table] = _dealt(given[table], size)
    sql = _text(name, "spark")
    for n in given:
        sql = re.sub(rf"\bFROM {n}\b", f"FROM {{{n}}}", sql)
    return spark.sql(sql, **given)


def with_fixtures(body: str, *names: str) -> str:
    """Oracle SQL: the fixtures that a query needs as common table expressions before it."""
    order: list[str] = []

    def add(n: str) -> None:
        if n in SQL and n not in order:
            for m in needs(n):
                add(m)
            order.append(n)

    for n in names:
        add(n)
    ctes = ", ".join(f"{n} AS ({_text(n, 'duckdb')})" for n in order)
    body = body.strip()
    if not ctes:
        return body
    return f"WITH {ctes}, {body[5:]}" if body.startswith("WITH ") else f"WITH {ctes} {body}"
