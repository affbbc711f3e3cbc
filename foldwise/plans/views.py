"""Role views: the driver's test tables re-cast into the roles the operators use.

The library's operators take column names; these views only bind names.  Each
view exists twice: as a DataFrame builder and as SQL text, so oracle queries can
be written against the very same derived rows.

* ``obs``  - imputation view: key, three group keys, a measure with NULLs
  injected by a fixed rule so that every fallback tier is exercised.
* ``olab`` - scalable classification view with a known signal.
* ``pax``  - the full raw record of the reference's feature row, one role per
  column (see ``PAX_ROLE_SOURCES``), built from orders, customer, nation and a
  per-order lineitem aggregate.
* ``clf``  - documents joined with their quality labels.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

OBS_SQL = """
SELECT o_orderkey AS id, o_orderpriority AS k1, c_mktsegment AS k2, n_regionkey AS k3,
       CASE WHEN o_orderkey % 7 = 0
              OR (o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING' AND n_regionkey = 0)
              OR (o_orderpriority = '2-HIGH' AND c_mktsegment = 'FURNITURE')
              OR o_orderpriority = '5-LOW'
            THEN NULL ELSE o_totalprice END AS v
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

OLAB_SQL = """
SELECT o_orderkey AS id,
       CAST(CASE WHEN (o_totalprice > 250000) <> (o_orderkey % 10 = 0) THEN 1 ELSE 0 END AS INTEGER) AS label,
       o_totalprice, o_orderpriority, o_orderstatus, c_mktsegment, c_acctbal,
       CAST(month(o_orderdate) AS INTEGER) AS o_month
FROM orders JOIN customer ON o_custkey = c_custkey
"""

# Raw record in the reference's column roles.  Left: role, right: source.
PAX_ROLE_SOURCES = {
    "key": "o_orderkey",
    "label": "olab rule on o_totalprice / o_orderkey",
    "cls": "n_regionkey (ordered class)",
    "name": "c_name (title source)",
    "sex": "o_orderstatus (two-value category F/O; P is 'other')",
    "age": "c_acctbal, NULL for keys % 7 = 0, for priority 5-LOW, and for region 1 with status P",
    "sibsp": "lineitems of the order - 1",
    "parch": "returned lineitems of the order",
    "ticket": "o_orderpriority (prefix source)",
    "fare": "o_totalprice, NULL for keys % 13 = 0",
    "cabin": "n_name, NULL for keys % 3 = 0",
    "embarked": "c_mktsegment, NULL for keys % 11 = 0",
}

PAX_SQL = """
SELECT o_orderkey AS pid,
       CAST(CASE WHEN (o_totalprice > 250000) <> (o_orderkey % 10 = 0) THEN 1 ELSE 0 END AS INTEGER) AS survived,
       n_regionkey AS pclass,
       c_name AS name,
       o_orderstatus AS sex,
       CASE WHEN o_orderkey % 7 = 0 OR o_orderpriority = '5-LOW'
              OR (n_regionkey = 1 AND o_orderstatus = 'P') THEN NULL ELSE c_acctbal END AS age,
       CAST(GREATEST(COALESCE(li.n_lines, 0) - 1, 0) AS INTEGER) AS sibsp,
       CAST(COALESCE(li.n_returned, 0) AS INTEGER) AS parch,
       o_orderpriority AS ticket,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS fare,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE n_name END AS cabin,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS embarked
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines,
             SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned
      FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o_orderkey
"""

CLF_SQL = """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

VIEW_SQL = {"obs": OBS_SQL, "olab": OLAB_SQL, "pax": PAX_SQL, "clf": CLF_SQL}

# which driver tables each view reads
VIEW_TABLES = {
    "obs": ["orders", "customer", "nation"],
    "olab": ["orders", "customer"],
    "pax": ["orders", "customer", "nation", "lineitem"],
    "clf": ["documents", "labels"],
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a role view over the tables of ``sf_dir``.

    The tables are bound as DataFrame arguments of ``spark.sql`` (no session
    temp views are created or replaced).  The SQL is planned by Catalyst like
    any DataFrame: only the referenced columns are read, and the small
    dimension sides are broadcast from their measured size.
    """
    tables = VIEW_TABLES[name]
    sql = VIEW_SQL[name]
    for t in tables:
        sql = re.sub(rf"\b{t}\b", "{" + t + "}", sql)
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables})


def oracle_with(name: str, body: str) -> str:
    """Prefix a DuckDB oracle statement with the view as a CTE."""
    return f"WITH {name} AS ({VIEW_SQL[name]})\n{body}"


def oracle_with_many(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{body}"
