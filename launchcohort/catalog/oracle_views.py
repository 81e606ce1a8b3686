"""DuckDB forms of the views in `tables.py`, as named subqueries that the oracle texts start with."""

from __future__ import annotations

from launchcohort.catalog.tables import LAUNCH_FROM, LAUNCH_TO, PSEUDO_MODELS
from launchcohort.functions.scalars import NUMBER, SPACE, epoch_of

FROM, TO = epoch_of(LAUNCH_FROM), epoch_of(LAUNCH_TO)


def key_hash(key: str, seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT)"


def number(text: str) -> str:
    return f"(CASE WHEN regexp_matches({text}, '{NUMBER}') THEN TRY_CAST(trim({text}) AS DOUBLE) END)"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def json_field(text: str, field: str) -> str:
    return (f"coalesce(CASE WHEN json_valid({text}) THEN CASE WHEN json_type({text}) = 'OBJECT' "
            f"THEN json_extract_string({text}, '$.{field}') END END, 'unknown')")


def words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{SPACE}]+'))::INTEGER"


RAW = """
raw_base AS (
  SELECT o.*, o_orderkey AS id, o_orderkey % 53 = 0 AS repeats,
    CASE WHEN o_orderkey % 53 = 0 THEN 852076800 ELSE epoch(o_orderdate)::BIGINT END AS launch,
    CASE WHEN o_orderkey % 53 = 0 THEN 30 WHEN o_orderkey % 61 = 0 THEN 0 ELSE 15 + o_orderkey % 46 END AS days,
    CASE WHEN o_orderkey % 53 = 0 THEN o_orderkey % 3 ELSE o_orderkey % (SELECT count(*) FROM part) END AS part_no,
    CASE WHEN o_orderkey % 53 = 0 THEN o_orderkey % 2 ELSE o_orderkey % (SELECT count(*) FROM benchmark) END AS item_no,
    CASE WHEN o_orderkey < (SELECT count(*) FROM orders) * 0.5 THEN 1
         WHEN o_orderkey < (SELECT count(*) FROM orders) * 0.8 THEN 2 ELSE 3 END AS first_snapshot,
    CASE WHEN o_orderkey % 53 = 0 AND o_orderkey % 4 = 1 THEN greatest(CASE WHEN o_orderkey < (SELECT count(*) FROM orders) * 0.8 THEN 2 ELSE 3 END, 2)
         ELSE 3 END AS last_snapshot
  FROM orders o),
raw_joined AS (
  SELECT * FROM raw_base
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON part_no = p_partkey
  JOIN benchmark ON item_no = item_id),
raw AS (
  SELECT id, p_name AS name, text AS blurb,
    CASE WHEN id % 97 = 0 THEN 'bad' WHEN id % 89 = 0 THEN '0' ELSE o_totalprice::VARCHAR END AS goal,
    CASE WHEN snapshot < 3 AND id % 5 = 0 THEN 'live' WHEN o_orderstatus = 'F' THEN 'successful'
         WHEN o_orderstatus = 'O' THEN 'failed' ELSE 'live' END AS state,
    CASE WHEN id % 79 <> 0 THEN n_name END AS country, r_name AS currency,
    CASE WHEN id % 103 = 0 THEN '1e30' ELSE (launch + days * 86400)::VARCHAR END AS deadline, (launch - (1 + id % 40) * 86400)::VARCHAR AS created_at,
    CASE WHEN id % 101 = 0 THEN 'inf' ELSE launch::VARCHAR END AS launched_at,
    CASE WHEN id % 83 <> 0 THEN '1.' || r_regionkey END AS static_usd_rate,
    CASE WHEN id % 73 = 0 THEN '{bad' WHEN id % 71 = 0 THEN NULL WHEN id % 74 = 0 THEN '{''name'':''single''}' WHEN id % 75 = 0 THEN '{"name":"x"} more' ELSE
      '{"name":"' || c_mktsegment || '-' || o_orderpriority || '","slug":"' || c_mktsegment || '/' || o_orderpriority || '"}' END AS category,
    CASE WHEN id % 67 = 0 THEN '[1]' ELSE '{"name":"' || c_name || '","type":"' || o_orderpriority || '"}' END AS location,
    snapshot, id % 7 AS chunk, id AS row_no
  FROM raw_joined JOIN (SELECT unnest([1, 2, 3]) AS snapshot) ON snapshot BETWEEN first_snapshot AND last_snapshot)"""

LATEST = RAW + """,
latest AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY snapshot DESC, chunk DESC, row_no DESC) = 1)"""

NORMAL = LATEST + f""",
normal AS (
  SELECT id, coalesce(name, '') AS name, coalesce(blurb, '') AS blurb, state,
    {number('goal')} * coalesce({number('static_usd_rate')}, 1.0) AS goal_usd,
    coalesce({number('static_usd_rate')}, 1.0) AS usd_rate,
    coalesce(currency, 'unknown') AS currency, coalesce(country, 'unknown') AS country,
    {json_field('category', 'name')} AS category,
    lower({strip("split_part(" + json_field('category', 'slug') + ", '/', 1)")}) AS parent_category,
    {json_field('location', 'name')} AS location, {json_field('location', 'type')} AS location_type,
    TRY_CAST({number('launched_at')} AS BIGINT) AS launched_at, TRY_CAST({number('deadline')} AS BIGINT) AS deadline,
    snapshot, chunk, row_no
  FROM latest)"""

VALID = NORMAL + """,
valid AS (
  SELECT *, CASE state WHEN 'successful' THEN 1 ELSE 0 END AS y FROM normal
  WHERE state IN ('successful', 'failed') AND goal_usd > 0 AND deadline > launched_at)"""

CAMPAIGNS = VALID + """,
campaigns AS (
  SELECT id, name, blurb, goal_usd, usd_rate, currency, country, category, parent_category,
    location, location_type, launched_at, deadline, y
  FROM valid
  QUALIFY row_number() OVER (PARTITION BY name, blurb, launched_at, deadline ORDER BY snapshot DESC, chunk DESC, row_no DESC, id DESC) = 1)"""

DOC_LABELS = """
doc_labels AS (
  SELECT d.doc_id AS id, d.text, d.lang, d.source, l.quality AS y
  FROM documents d JOIN labels l USING (doc_id))"""

_MODELS = ", ".join(f"('{m}', {c})" for m, c in PSEUDO_MODELS.items())
_KEY = "model || '/' || id"
PREDICTIONS = f"""
finished AS (
  SELECT o_orderkey AS id, (o_orderstatus = 'F')::INTEGER AS y FROM orders WHERE o_orderstatus IN ('F', 'O')),
predicted AS (
  SELECT model, id, y, CASE WHEN {key_hash(_KEY, 1)} % 100 < hits THEN y ELSE 1 - y END AS pred
  FROM finished, (VALUES {_MODELS}) m(model, hits)),
predictions AS (
  SELECT model, id, y, pred::DOUBLE * 0.4::DOUBLE + ({key_hash(_KEY, 2)} % 1000)::DOUBLE / 1000.0::DOUBLE * 0.6::DOUBLE AS score, pred
  FROM predicted)"""
