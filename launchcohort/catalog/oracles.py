"""The same results as plain SQL for DuckDB, over whole tables."""

from __future__ import annotations

from launchcohort.catalog import oracle_views as V
from launchcohort.catalog import queries as Q
from launchcohort.catalog.tables import PSEUDO_MODELS
from launchcohort.functions.scalars import SPACE, epoch_of
from launchcohort.functions.text import TOKEN, english_stop_words
from launchcohort.operators.encoders import CAT_COLS
from launchcohort.operators.models import BEST
from launchcohort.operators.scenarios import MULTIPLIERS

MID = epoch_of("1998-01-01")
DEDUPE = "PARTITION BY name, blurb, launched_at, deadline ORDER BY snapshot DESC, chunk DESC, row_no DESC, id DESC"
USED = "id, name, blurb, goal, state, country, currency, deadline, created_at, launched_at, static_usd_rate, category, location"


def text_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def over(views: str, select: str) -> str:
    return f"WITH {views}\n{select}"


# ---------------------------------------------------------------- campaign features
def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


DAY_OF = "make_timestamp(launched_at * 1000000)"
STATIC = V.CAMPAIGNS + f""",
static AS (
  SELECT *, ln(1 + goal_usd) AS m_log_goal, (deadline - launched_at) / 86400.0::DOUBLE AS m_duration_days,
    month({DAY_OF})::INTEGER AS m_launch_month, (isodow({DAY_OF}) - 1)::INTEGER AS m_launch_dow,
    length(blurb)::INTEGER AS m_blurb_len, length(name)::INTEGER AS m_name_len,
    {V.words('blurb')} AS m_blurb_words, {V.words('name')} AS m_name_words
  FROM campaigns)"""

LEVELS = ", ".join(f"('{c}', {c})" for c in CAT_COLS)


def unpivoted(source: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT id, '{c}' AS \"column\", {c} AS level FROM {source}" for c in columns)


def split(order: str, seed_hash: bool) -> str:
    key = V.key_hash("id", 42) if seed_hash else "launched_at"
    return V.CAMPAIGNS + f""",
split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY {key}, id) <= floor((SELECT count(*) FROM campaigns) * 0.7::DOUBLE)
    THEN 'train' ELSE 'test' END AS split
  FROM campaigns)"""


RANDOM_SPLIT, TEMPORAL_SPLIT = split("hash", True), split("launch", False)
FOLD = f"({V.key_hash('id', 42)} % 5)"


def out_of_fold() -> str:
    """Refits every column once per fold on the rows of the other folds."""
    views = [V.CAMPAIGNS, f"folded AS (SELECT *, {FOLD} AS fold FROM campaigns)", "folds AS (SELECT unnest(range(5)) AS f)",
             "priors AS (SELECT f, avg(y) AS prior FROM folds JOIN folded ON fold <> f GROUP BY f)"]
    picks, joins = [], []
    for i, c in enumerate(CAT_COLS):
        views.append(f"fit{i} AS (SELECT f, {c} AS level, sum(y) AS s, count(*) AS n FROM folds JOIN folded ON fold <> f GROUP BY f, {c})")
        joins.append(f"LEFT JOIN fit{i} ON fit{i}.f = fold AND fit{i}.level = folded.{c}")
        picks.append(r6(f"(coalesce(fit{i}.s, 0) + 20.0 * prior) / (coalesce(fit{i}.n, 0) + 20.0)", f"m_te_{c}"))
    return over(", ".join(views), f"SELECT id, {', '.join(picks)} FROM folded JOIN priors ON priors.f = fold {' '.join(joins)}")


def encode_new() -> str:
    views = [TEMPORAL_SPLIT, "train AS (SELECT * FROM split WHERE split = 'train')", "prior AS (SELECT avg(y) AS prior FROM train)"]
    picks, joins = [], []
    for i, c in enumerate(CAT_COLS):
        views.append(f"fit{i} AS (SELECT {c} AS level, (sum(y) + 20.0 * max(prior)) / (count(*) + 20.0) AS te FROM train, prior GROUP BY {c})")
        joins.append(f"LEFT JOIN fit{i} ON fit{i}.level = s.{c}")
        picks.append(r6(f"coalesce(fit{i}.te, prior)", f"m_te_{c}"))
    return over(", ".join(views), f"SELECT s.id, {', '.join(picks)} FROM split s {' '.join(joins)}, prior WHERE s.split = 'test'")


def goal_columns(difference: bool) -> str:
    views = [STATIC, "prior AS (SELECT avg(m_log_goal) AS prior FROM static)"]
    picks, joins = [], []
    for i, c in enumerate(CAT_COLS):
        views.append(f"fit{i} AS (SELECT {c} AS level, (sum(m_log_goal) + 20.0 * max(prior)) / (count(*) + 20.0) AS g FROM static, prior GROUP BY {c})")
        joins.append(f"JOIN fit{i} ON fit{i}.level = s.{c}")
        picks.append(r6(f"m_log_goal - fit{i}.g", f"m_goaldiff_{c}") if difference else r6(f"fit{i}.g", f"m_goalmean_{c}"))
    return over(", ".join(views), f"SELECT s.id, {', '.join(picks)} FROM static s {' '.join(joins)}")


# ---------------------------------------------------------------- predictions
CELLS = """
count(*) FILTER (y = 0 AND pred = 0) AS n00, count(*) FILTER (y = 0 AND pred = 1) AS n01,
count(*) FILTER (y = 1 AND pred = 0) AS n10, count(*) FILTER (y = 1 AND pred = 1) AS n11"""


def share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE ({part})::DOUBLE / ({whole}) END"


CLASS_METRICS = {
    "A": share("n00 + n11", "n00 + n01 + n10 + n11"), "F1": share("2 * n11", "2 * n11 + n01 + n10"),
    "P1": share("n11", "n11 + n01"), "P0": share("n00", "n00 + n10"),
    "R1": share("n11", "n11 + n10"), "R0": share("n00", "n00 + n01"),
}
RATED = V.PREDICTIONS + f""",
rated AS (SELECT model, {', '.join(f'{e} AS {n}' for n, e in CLASS_METRICS.items())}
  FROM (SELECT model, {CELLS} FROM predictions GROUP BY model))"""
AREAS = """,
scored AS (SELECT model, score, sum(y) AS pos, sum(1 - y) AS neg FROM predictions GROUP BY model, score),
areas AS (
  SELECT model, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS AUC
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM scored)
  GROUP BY model)"""
RUNS = V.PREDICTIONS + f""",
runs AS (SELECT model AS sample, seed, length(model)::INTEGER AS n_features, {CLASS_METRICS['A']} AS A, {CLASS_METRICS['F1']} AS F1
  FROM (SELECT model, {V.key_hash('id', 7)} % 5 AS seed, {CELLS} FROM predictions GROUP BY ALL)),
summary AS (SELECT sample, max(n_features) AS n_features, count(*) AS n_runs, avg(A) AS acc_mean, stddev_pop(A) AS acc_std,
  avg(F1) AS f1_mean, stddev_pop(F1) AS f1_std,
  string_agg(round(A * 1000000)::BIGINT::VARCHAR, ',' ORDER BY seed) AS accs,
  string_agg(round(F1 * 1000000)::BIGINT::VARCHAR, ',' ORDER BY seed) AS f1s FROM runs GROUP BY sample)"""


def pair_cells(pairs) -> str:
    values = ", ".join(f"('{a}', '{b}')" for a, b in pairs)
    return V.PREDICTIONS + f""",
pairs AS (
  SELECT p.A, p.B, count(*) AS n,
    count(*) FILTER (a.pred = a.y AND b.pred <> b.y) AS a_only,
    count(*) FILTER (a.pred <> a.y AND b.pred = b.y) AS b_only
  FROM (VALUES {values}) p(A, B) JOIN predictions a ON a.model = p.A JOIN predictions b ON b.model = p.B AND b.id = a.id
  GROUP BY p.A, p.B),
tested AS (
  SELECT *, CASE WHEN a_only + b_only = 0 OR a_only = b_only THEN 1.0 ELSE least(1.0, (
    SELECT 2 * sum(exp(lgamma(t.m + 1) - lgamma(k + 1) - lgamma(t.m - k + 1) - t.m * ln(2)))
    FROM range(0, least(t.a_only, t.b_only) + 1) r(k))) END AS mcnemar_p
  FROM (SELECT *, a_only + b_only AS m FROM pairs) t)"""


_NAMES = list(PSEUDO_MODELS)
PLANNED = [("OLS", "Chance"), ("R. Forest", "OLS"), ("Logistic", "OLS"), *[(BEST, m) for m in _NAMES if m != BEST]]

# ---------------------------------------------------------------- text
def tokens(text: str) -> str:
    stops = text_list(english_stop_words())
    return f"list_filter(regexp_extract_all(lower({text}), '{TOKEN}'), lambda t: t NOT IN ({stops}))"


def term_views(source: str, prefix: str = "") -> str:
    """(id, term, tf) of a table of texts."""
    return f"""
{prefix}counts AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({tokens('text')}) AS term FROM {source}) GROUP BY id, term)"""


def vocab_views(source: str, prefix: str = "") -> str:
    return term_views(source, prefix) + f""",
vocab AS (SELECT term, df, ln((1.0 + n) / (1.0 + df)) + 1 AS idf
  FROM (SELECT term, count(*) AS df, (SELECT count(*) FROM {source}) AS n FROM {prefix}counts GROUP BY term)
  WHERE df >= 10 AND df <= 0.35::DOUBLE * n)"""


def weight_views(prefix: str = "") -> str:
    return f"""
{prefix}raw_weights AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM {prefix}counts JOIN vocab USING (term)),
{prefix}weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {prefix}raw_weights)"""


DOCS = "docs AS (SELECT doc_id AS id, text, lang, source FROM documents)"
LABELLED = ", ".join([V.DOC_LABELS, vocab_views("doc_labels", "fit_"), weight_views("fit_"), "v AS (SELECT count(*) AS size FROM vocab)"])
NAIVE_BAYES = over(", ".join([
    LABELLED, DOCS, term_views("docs"), weight_views(),
    "mass AS (SELECT y, sum(w) AS total FROM fit_weights JOIN doc_labels USING (id) GROUP BY y)",
    "terms AS (SELECT term, coalesce(sum(w) FILTER (y = 1), 0) AS w1, coalesce(sum(w) FILTER (y = 0), 0) AS w0 FROM vocab LEFT JOIN (SELECT term, w, y FROM fit_weights JOIN doc_labels USING (id)) USING (term) GROUP BY term)",
    """odds AS (SELECT term, ln((w1 + 1) / ((SELECT total FROM mass WHERE y = 1) + (SELECT size FROM v)))
      - ln((w0 + 1) / ((SELECT total FROM mass WHERE y = 0) + (SELECT size FROM v))) AS o FROM terms)""",
    "prior AS (SELECT ln(sum(y) / sum(1 - y)) AS p FROM doc_labels)",
    "evidence AS (SELECT id, sum(w * o) AS e FROM weights JOIN odds USING (term) GROUP BY id)"]),
    f"SELECT id, {r6('1 / (1 + exp(-(p + coalesce(e, 0))))', 'nb_prob')} FROM docs LEFT JOIN evidence USING (id), prior")
OUT_OF_FOLD_BAYES = over(", ".join([
    LABELLED, f"folded AS (SELECT *, {FOLD} AS fold FROM doc_labels)", "folds AS (SELECT unnest(range(5)) AS f)",
    "mass AS (SELECT f, y, sum(w) AS total FROM folds JOIN folded ON fold <> f JOIN fit_weights USING (id) GROUP BY f, y)",
    "terms AS (SELECT f, term, sum(w) FILTER (y = 1) AS w1, sum(w) FILTER (y = 0) AS w0 FROM folds JOIN folded ON fold <> f JOIN fit_weights USING (id) GROUP BY f, term)",
    """odds AS (SELECT g.f, g.term, ln((coalesce(w1, 0) + 1) / (m1.total + (SELECT size FROM v)))
      - ln((coalesce(w0, 0) + 1) / (m0.total + (SELECT size FROM v))) AS o
      FROM (SELECT f, term FROM folds, vocab) g LEFT JOIN terms ON terms.f = g.f AND terms.term = g.term
      JOIN mass m1 ON m1.f = g.f AND m1.y = 1 JOIN mass m0 ON m0.f = g.f AND m0.y = 0)""",
    "prior AS (SELECT f, ln(sum(y) / sum(1 - y)) AS p FROM folds JOIN folded ON fold <> f GROUP BY f)",
    "evidence AS (SELECT id, sum(w * o) AS e FROM fit_weights JOIN folded USING (id) JOIN odds ON odds.f = fold AND odds.term = fit_weights.term GROUP BY id)"]),
    f"SELECT id, {r6('1 / (1 + exp(-(p + coalesce(e, 0))))', 'nb_prob')} FROM folded JOIN prior ON f = fold LEFT JOIN evidence USING (id)")


def marks(text: str, mark: str) -> str:
    return f"(length({text}) - length(replace({text}, '{mark}', '')))"


def emphasis(text: str) -> str:
    asks = marks(text, "?")
    return (f"(least({marks(text, '!')}, 4) * 0.292::DOUBLE + CASE WHEN {asks} > 3 THEN 0.96::DOUBLE "
            f"WHEN {asks} > 1 THEN {asks} * 0.18::DOUBLE ELSE 0 END)")


def compound(total: str, stress: str) -> str:
    moved = f"({total} + sign({total}) * {stress})"
    return f"({moved} / sqrt({moved} * {moved} + 15.0))"


def scored(same_part: bool) -> str:
    value = "valence"
    for d, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
        near = f"part_{d} = part" if same_part else "true"
        value = (f"(({value}) + CASE WHEN {near} THEN sign(valence) * coalesce(shift_{d}, 0) * {damping}::DOUBLE ELSE 0 END)"
                 f" * CASE WHEN {near} THEN coalesce(turn_{d}, 1) ELSE 1 END")
    return value


PARTS = f"""
split_parts AS (SELECT doc_id AS id, text, list_filter(string_split(regexp_replace({V.strip('text')},
  '([.!?])[{SPACE}]+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS found FROM documents),
parts AS (SELECT id, text, CASE WHEN len(found) > 0 THEN found ELSE [text] END AS sentences FROM split_parts)"""
_LAGS = ", ".join(f"lag({c}, {d}) OVER (PARTITION BY id ORDER BY part, place) AS {c}_{d}"
                  for c in ("shift", "turn", "part") for d in (1, 2, 3))
_BOOST = "CASE term " + " ".join(f"WHEN '{t}' THEN {v}::DOUBLE" for t, v in Q.BOOSTERS.items()) + " ELSE 0 END"
SENTIMENT = over(PARTS + f""",
lexicon AS (SELECT * FROM (VALUES {', '.join(f"('{t}', {v}::DOUBLE)" for t, v in Q.LEXICON.items())}) l(term, valence)),
sentence AS (SELECT id, {emphasis('text')} AS stress, len(sentences) AS n_sentences, unnest(sentences) AS sentence,
  generate_subscripts(sentences, 1) AS part FROM parts),
word_lists AS (SELECT * EXCLUDE (sentence), {emphasis('sentence')} AS part_stress,
  list_filter(list_transform(regexp_split_to_array(sentence, '[{SPACE}]+'),
    lambda w: lower(regexp_replace(w, '^[\\p{{P}}\\p{{S}}]+|[\\p{{P}}\\p{{S}}]+$', '', 'g'))), lambda w: w <> '') AS words FROM sentence),
words AS (SELECT * EXCLUDE (words), unnest(words) AS term, generate_subscripts(words, 1) AS place FROM word_lists),
known AS (SELECT words.*, valence, CASE WHEN valence IS NULL THEN {_BOOST} END AS shift,
  CASE WHEN valence IS NULL AND term IN ({text_list(Q.NEGATORS)}) THEN -0.74::DOUBLE ELSE 1 END AS turn
  FROM words LEFT JOIN lexicon USING (term)),
seen AS (SELECT *, {_LAGS},
  min(CASE WHEN term = 'but' THEN part * 1000000 + place END) OVER (PARTITION BY id) AS but_at,
  min(CASE WHEN term = 'but' THEN place END) OVER (PARTITION BY id, part) AS but_place FROM known),
hits AS (SELECT *, {scored(False)} * CASE WHEN part * 1000000 + place < but_at THEN 0.5 WHEN part * 1000000 + place > but_at THEN 1.5 ELSE 1 END AS whole,
  {scored(True)} * CASE WHEN place < but_place THEN 0.5 WHEN place > but_place THEN 1.5 ELSE 1 END AS alone
  FROM seen WHERE valence IS NOT NULL),
per_part AS (SELECT id, part, any_value(stress) AS stress, any_value(n_sentences) AS n_sentences, any_value(part_stress) AS part_stress,
  sum(whole) AS whole, sum(alone) AS alone FROM hits GROUP BY id, part),
per_text AS (SELECT id, {compound('sum(whole)', 'any_value(stress)')} AS c, sum({compound('alone', 'part_stress')}) / any_value(n_sentences) AS m
  FROM per_part GROUP BY id)""",
    "SELECT parts.id, round(coalesce(c, 0), 4) AS sent_compound, round(coalesce(m, 0), 4) AS sent_mean_sentence FROM parts LEFT JOIN per_text USING (id)")

SAFE = "substr(regexp_replace(level, '[^0-9a-zA-Z_]+', '_', 'g'), 1, 30)"
ONE_HOT = over(V.CAMPAIGNS + f""",
pairs AS ({unpivoted('campaigns', ['parent_category', 'category'])}),
frequent AS (SELECT "column", level, count(*) AS n, sum(id) AS id_sum FROM pairs GROUP BY ALL HAVING count(*) >= 50),
numbered AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY level) - 1 AS i FROM frequent)""",
    f"""SELECT 'm_oh_' || CASE "column" WHEN 'category' THEN 'cat' ELSE 'par' END || i || '_' || {SAFE} AS feature,
  n AS ones, id_sum::BIGINT AS id_sum FROM numbered""")

DECILES = over(V.CAMPAIGNS + """,
edges AS (SELECT DISTINCT unnest(quantile_cont(goal_usd, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM campaigns),
binned AS (SELECT y, goal_usd, (SELECT count(*) FROM edges WHERE e < goal_usd)::INTEGER AS bin FROM campaigns)""",
    "SELECT bin, count(*) AS n, round(avg(y), 6) AS rate, round(median(goal_usd), 6) AS goal FROM binned GROUP BY bin")

_MEANS = ", ".join(f"avg({c}) AS {c}_mean" for c in Q.LINEAR)
_PARTS = " UNION ALL ".join(
    f"SELECT id, '{c}' AS feature, {w}::DOUBLE * ({c} - {c}_mean) AS contribution FROM static, means" for c, w in Q.LINEAR.items())
_AUDIT = """
facts AS (SELECT strftime(o_orderdate, '%Y-%m') AS stamp, count(*) / 7.0::DOUBLE AS mb, count(DISTINCT day(o_orderdate)) AS chunks,
  max(o_custkey) % 9 > 0 AS valid_zip FROM orders GROUP BY 1),
manifest AS (SELECT strftime(l_shipdate, '%Y-%m') AS stamp, count(DISTINCT day(l_shipdate)) AS expected_chunks,
  count(*) / 28.0::DOUBLE AS expected_mb FROM lineitem GROUP BY 1),
judged AS (SELECT stamp, CASE WHEN valid_zip IS NULL THEN 'not downloaded' WHEN NOT valid_zip THEN 'not a valid zip'
  WHEN chunks <> expected_chunks THEN 'truncated: ' || chunks || ' csv chunks, expected ' || expected_chunks
  WHEN abs(mb - expected_mb) / expected_mb > 0.02 THEN 'size ' || printf('%.0f', mb) || ' MB differs from expected ' || printf('%.0f', expected_mb) || ' MB'
  END AS bad, chunks || ' chunks, ' || printf('%.0f', mb) || ' MB' AS good
  FROM manifest LEFT JOIN facts USING (stamp))"""

FUNNEL = """
SELECT (SELECT count(*) FROM raw) AS n_rows_read, (SELECT count(*) FROM latest) AS n_unique_ids,
  (SELECT count(*) FROM latest WHERE state IN ('successful', 'failed')) AS n_finished,
  (SELECT count(*) FROM inside) AS n_after_window,
  (SELECT count(*) FROM inside) - (SELECT count(*) FROM kept) AS n_dropped_name_dupes, (SELECT count(*) FROM kept) AS n_final"""
_INSIDE = V.VALID + f""",
inside AS (SELECT * FROM valid WHERE launched_at >= {V.FROM} AND launched_at < {V.TO}),
kept AS (SELECT DISTINCT name, blurb, launched_at, deadline FROM inside)"""

EARLY = V.CAMPAIGNS + f", early AS (SELECT * FROM campaigns WHERE launched_at < {MID})"
GUARDS = {"repeated_id": "count(*) - count(DISTINCT id)", "bad_label": "count(*) FILTER (state NOT IN ('successful', 'failed'))"}
_NORMAL_RAW = V.NORMAL.replace("FROM latest)", "FROM raw)").replace("SELECT id, coalesce(name", "SELECT id, snapshot, coalesce(name")
for _c, _e in (("goal_usd", "goal_usd"), ("launched_at", "launched_at"), ("deadline", "deadline")):
    GUARDS[f"missing_{_c}"] = f"count(*) FILTER ({_e} IS NULL)"

ORACLES: dict[str, str] = {
    "s1_csv_scan": over(V.RAW, f"SELECT {USED.replace('id,', 'id::VARCHAR AS id,', 1)} FROM raw"),
    "s2_archive_scan": over(V.RAW, f"SELECT {USED.replace('id,', 'id::VARCHAR AS id,', 1)} FROM raw"),
    "s3_file_listing": over(V.RAW, "SELECT DISTINCT 'snapshot_00' || snapshot AS folder FROM raw"),
    "s4_snapshot_union": over(V.RAW, """SELECT 'snapshot_00' || snapshot AS folder, count(*) AS n_rows_read,
  count(*) FILTER (state = 'live') AS n_live FROM raw GROUP BY 1"""),
    "s5_audit_verdicts": over(_AUDIT, "SELECT stamp, bad IS NULL AS ok, coalesce(bad, good) AS reason FROM judged"),
    "s6_fingerprint": f"""SELECT substr(sha256(string_agg(line, chr(10) ORDER BY path) || chr(10) || 'from={V.FROM}|to=None'), 1, 16) AS fingerprint
FROM (SELECT 'raw/' || substr(m, 1, 4) || '/dump_' || m || '.zip' AS path, 'dump_' || m || '.zip:' || n AS line
  FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m, count(*) AS n FROM orders GROUP BY 1))""",
    "s7_cached_table": over(V.CAMPAIGNS, """SELECT count(*) AS n, sum(y)::BIGINT AS y, sum(launched_at)::BIGINT AS launched_at,
  count(DISTINCT location) AS locations, (SELECT count(*) FROM raw) AS n_rows_read, (SELECT count(*) FROM latest) AS n_unique_ids,
  (SELECT count(*) FROM latest WHERE state IN ('successful', 'failed')) AS n_finished, count(*) AS n_final FROM campaigns"""),
    "s9_cumulative_snapshots": """SELECT snapshot, count(*) AS n, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
FROM orders JOIN (VALUES (1, 0.5::DOUBLE), (2, 0.8::DOUBLE), (3, 1.0::DOUBLE)) s(snapshot, share)
  ON o_orderkey < floor((SELECT count(*) FROM orders) * share) GROUP BY snapshot""",
    "s10_result_sinks": over(RATED, f"SELECT model, {r6('A', 'A')}, {r6('F1', 'F1')}, {r6('F1', 'F1_json')} FROM rated"),
    "s11_saved_bundle": over(RANDOM_SPLIT, "SELECT id, y, true AS same_score FROM split WHERE split = 'test'"),
    "p1_json_fields": over(V.RAW, f"""SELECT id, snapshot, {V.json_field('category', 'slug')} AS slug, {V.json_field('category', 'name')} AS category_name,
  {V.json_field('location', 'name')} AS location_name, {V.json_field('location', 'type')} AS location_type FROM raw"""),
    "p2_parent_category": over(_NORMAL_RAW, "SELECT id, snapshot, parent_category FROM normal"),
    "p3_numeric_cast": over(V.RAW + """,
forms AS (SELECT id, snapshot, launched_at, CASE id % 7 WHEN 0 THEN goal WHEN 1 THEN goal || 'd' WHEN 2 THEN ' ' || goal || ' '
  WHEN 3 THEN '-' || goal WHEN 4 THEN 'NaN' WHEN 5 THEN goal || 'e1' ELSE name END AS form FROM raw)""",
        f"SELECT id, snapshot, {V.number('form')} AS number, {V.number('launched_at')} AS launched_at FROM forms"),
    "p4_goal_usd": over(_NORMAL_RAW, f"SELECT id, snapshot, {r6('goal_usd', 'goal_usd')}, {r6('usd_rate', 'usd_rate')} FROM normal"),
    "p5_null_defaults": over(_NORMAL_RAW, "SELECT id, snapshot, name, country, currency FROM normal"),
    "p6_label": over(V.RAW, "SELECT id, snapshot, state, CASE state WHEN 'successful' THEN 1 WHEN 'failed' THEN 0 ELSE -1 END AS y FROM raw"),
    "p7_log_goal": over(STATIC, f"SELECT id, {r6('m_log_goal', 'm_log_goal')} FROM static"),
    "p8_duration_days": over(STATIC, "SELECT id, m_duration_days FROM static"),
    "p9_launch_parts": over(STATIC, "SELECT id, m_launch_month, m_launch_dow FROM static"),
    "p10_text_sizes": f"SELECT doc_id AS id, length(text)::INTEGER AS m_blurb_len, {V.words('text')} AS m_blurb_words FROM documents",
    "p11_one_hot": ONE_HOT,
    "p12_sentences": over(PARTS, "SELECT id, len(sentences)::INTEGER AS n_sentences, md5(array_to_string(sentences, '|')) AS sentences_md5 FROM parts"),
    "p14_iso_epoch": "SELECT o_orderkey AS id, epoch(o_orderdate::DATE)::BIGINT AS epoch FROM orders",
    "p15_verdict": over(V.PREDICTIONS, """SELECT model, id, CASE WHEN score >= 0.5 THEN 'Likely to reach its goal' ELSE 'More likely to fall short' END AS verdict,
  CASE WHEN score >= 0.5 THEN 'good' WHEN score >= 0.35 THEN 'mid' ELSE 'bad' END AS band FROM predictions"""),
    "f1_finished_only": over(V.LATEST, "SELECT id, state, CASE state WHEN 'successful' THEN 1 ELSE 0 END AS y FROM latest WHERE state IN ('successful', 'failed')"),
    "f2_required_fields": over(V.NORMAL, "SELECT id, launched_at, deadline FROM normal WHERE goal_usd IS NOT NULL AND launched_at IS NOT NULL AND deadline IS NOT NULL"),
    "f3_valid_rows": over(V.NORMAL, "SELECT id, launched_at, deadline FROM normal WHERE goal_usd > 0 AND deadline > launched_at"),
    "f4_launch_window": over(V.CAMPAIGNS, f"SELECT id, launched_at, y FROM campaigns WHERE launched_at >= {V.FROM} AND launched_at < {V.TO}"),
    "f5_no_banned_columns": over(V.LATEST, "SELECT * EXCLUDE (state, chunk, row_no) FROM latest"),
    "f6_table_guards": over(_NORMAL_RAW, " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", {e} AS n FROM normal" for n, e in GUARDS.items())),
    "d1_latest_per_id": over(V.LATEST, "SELECT id, snapshot, state, name, blurb, goal FROM latest"),
    "d2_repeats_dropped": over(V.CAMPAIGNS, "SELECT id, name, launched_at, deadline, y FROM campaigns"),
    "j1_level_lookup": over(EARLY + """,
prior AS (SELECT avg(y) AS p FROM early),
means AS (SELECT location, (sum(y) + 20.0 * max(p)) / (count(*) + 20.0) AS m FROM early, prior GROUP BY location)""",
        f"SELECT id, {r6('coalesce(m, p)', 'location_mean')} FROM campaigns LEFT JOIN means USING (location), prior"),
    "j2_parent_and_rate": over(EARLY + """,
parents AS (SELECT category, parent_category AS parent FROM (SELECT category, parent_category, count(*) AS n FROM early GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, parent_category) = 1),
rates AS (SELECT currency, median(usd_rate) AS rate FROM early GROUP BY currency)""",
        f"""SELECT id, coalesce(parent, 'unknown') AS parent_category, {r6('coalesce(rate, 1.0)', 'usd_rate')}
FROM campaigns LEFT JOIN parents USING (category) LEFT JOIN rates USING (currency)"""),
    "j3_paired_correctness": over(pair_cells(Q.MODEL_PAIRS), "SELECT * FROM pairs"),
    "j4_goal_ladder": over(V.CAMPAIGNS, f"""SELECT id * 7 + rung AS id, id AS base_id, rung, multiplier, {r6('goal_usd * multiplier', 'goal_usd')}
FROM campaigns, (VALUES {', '.join(f'({i}, {m}::DOUBLE)' for i, m in enumerate(MULTIPLIERS))}) m(rung, multiplier)"""),
    "a1_cohort_funnel": over(_INSIDE, FUNNEL),
    "a2_cohort_profile": over(V.CAMPAIGNS, f"""SELECT round(avg(y), 6) AS success_rate, strftime(make_timestamp(min(launched_at) * 1000000), '%Y-%m-%d') AS launch_min,
  strftime(make_timestamp(max(launched_at) * 1000000), '%Y-%m-%d') AS launch_max, count(DISTINCT category) AS n_categories,
  count(DISTINCT parent_category) AS n_parent_categories, count(DISTINCT country) AS n_countries,
  strftime(make_timestamp({V.FROM}::BIGINT * 1000000), '%Y-%m-%d') AS cohort_from, 'all' AS cohort_to, round(median(goal_usd), 6) AS goal_usd_median
FROM campaigns WHERE launched_at >= {V.FROM}"""),
    "a3_rate_by_parent": over(V.CAMPAIGNS, "SELECT parent_category, round(avg(y), 6) AS mean, count(*) AS size FROM campaigns GROUP BY 1 HAVING count(*) >= 50"),
    "a4_rate_by_goal_decile": DECILES,
    "a5_level_counts": over(V.CAMPAIGNS + f", pairs AS ({unpivoted('campaigns', ['parent_category', 'category'])})",
                            'SELECT "column", level, count(*) AS n FROM pairs GROUP BY ALL HAVING count(*) >= 50'),
    "a6_modal_parent": over(V.CAMPAIGNS, """SELECT category, parent_category FROM (SELECT category, parent_category, count(*) AS n FROM campaigns GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, parent_category) = 1"""),
    "a7_median_rate": over(V.CAMPAIGNS, f"SELECT currency, {r6('median(usd_rate)', 'usd_rate')} FROM campaigns GROUP BY currency"),
    "a8_distinct_levels": over(V.CAMPAIGNS + f", pairs AS ({unpivoted('campaigns', CAT_COLS)})", 'SELECT DISTINCT "column", level FROM pairs'),
    "a9_split_summary": over(RANDOM_SPLIT + """,
rates AS (SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'test') AS n_test,
  avg(y) FILTER (split = 'train') AS train, avg(y) FILTER (split = 'test') AS test FROM split)""",
        "SELECT n_train, n_test, round(train, 6) AS train_success_rate, round(test, 6) AS test_success_rate, round(greatest(test, 1 - test), 6) AS baseline_acc FROM rates"),
    "a10_confusion": over(V.PREDICTIONS, """SELECT m.model, c.y, c.pred, count(p.id) AS n
FROM (SELECT DISTINCT model FROM predictions) m CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(y, pred)
LEFT JOIN predictions p ON p.model = m.model AND p.y = c.y AND p.pred = c.pred GROUP BY ALL"""),
    "a11_class_metrics": over(RATED, "SELECT model, " + ", ".join(r6(c, c) for c in CLASS_METRICS) + " FROM rated"),
    "a12_auc": over(V.PREDICTIONS + AREAS, f"SELECT model, {r6('AUC', 'AUC')} FROM areas"),
    "a13_ablation_summary": over(RUNS, "SELECT sample, n_features, n_runs, " + ", ".join(
        r6(c, c) for c in ("acc_mean", "acc_std", "f1_mean", "f1_std")) + ", accs, f1s FROM summary"),
    "a14_report_deltas": over(RUNS, f"""SELECT sample, {r6('acc_mean', 'acc_mean')},
  {r6("100 * (acc_mean - (SELECT acc_mean FROM summary WHERE sample = 'Logistic'))", 'vs_first')},
  {r6("100 * (acc_mean - (SELECT acc_mean FROM summary WHERE sample = 'R. Forest'))", 'vs_second')} FROM summary"""),
    "a14_headline": over(RATED + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY A DESC, model) AS place FROM rated),
base AS (SELECT greatest(avg(y), 1 - avg(y)) AS b FROM predictions)""",
        f"""SELECT model, (SELECT count(*) FROM ranked) AS n_models, {r6('A', 'A')}, {r6('R0', 'R0')}, {r6('R1', 'R1')},
  {r6('100 * (A - b)', 'over_baseline')}, {r6('100 * (A - (SELECT A FROM ranked WHERE place = 2))', 'over_second')},
  {r6('100 * (A - (SELECT A FROM ranked WHERE place = 4))', 'over_fourth')} FROM ranked, base WHERE place = 1"""),
    "a15_significance_digest": over(pair_cells(Q.MODEL_PAIRS) + f""",
tests AS (SELECT CASE WHEN A = '{BEST}' THEN 'lead' ELSE 'ablation' END AS kind, CASE WHEN A = '{BEST}' THEN B ELSE A END AS name,
  (a_only - b_only) / n::DOUBLE AS diff, mcnemar_p, mcnemar_p < 0.05 AS sig FROM tested)""",
        f"""SELECT kind, count(*) AS n, coalesce(string_agg(name, ', ' ORDER BY name) FILTER (sig), '') AS significant,
  coalesce(string_agg(name, ', ' ORDER BY name) FILTER (NOT sig), '') AS not_significant, {r6('100 * min(diff)', 'lead_min')},
  {r6('100 * max(diff)', 'lead_max')}, {r6('max(mcnemar_p)', 'p_max')}, bool_and(sig) AS all_significant FROM tests GROUP BY kind"""),
    "w1_temporal_split": over(TEMPORAL_SPLIT, "SELECT id, launched_at, split FROM split"),
    "w2_model_table": over(RATED + AREAS, "SELECT model, " + ", ".join(r6(c, c) for c in (*CLASS_METRICS, "AUC")) + " FROM rated JOIN areas USING (model)"),
    "w3_top_levels": over(V.CAMPAIGNS + f", pairs AS ({unpivoted('campaigns', CAT_COLS)})",
                          'SELECT "column", level, count(*) AS n FROM pairs GROUP BY ALL ORDER BY n DESC, "column", level LIMIT 15'),
    "w3_top_contributions": over(STATIC + f", means AS (SELECT {_MEANS} FROM static), parts AS ({_PARTS}),\n"
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS place FROM parts)",
        f"SELECT id, place::INTEGER AS place, feature, {r6('contribution', 'contribution')} FROM ranked WHERE place <= 5"),
    "k1_random_split": over(RANDOM_SPLIT, "SELECT id, y, split FROM split"),
    "k2_folds": over(V.CAMPAIGNS, f"SELECT id, {FOLD}::INTEGER AS fold FROM campaigns"),
    "k3_sample": over(V.CAMPAIGNS, f"SELECT id, y FROM campaigns ORDER BY {V.key_hash('id', 42)}, id LIMIT 4000"),
    "e1_smoothed_means": over(V.CAMPAIGNS, f"""SELECT location AS level, count(*) AS n,
  {r6('(sum(y) + 20.0 * (SELECT avg(y) FROM campaigns)) / (count(*) + 20.0)', 'mean')} FROM campaigns GROUP BY location"""),
    "e2_encode_new_rows": encode_new(),
    "e3_out_of_fold_encoding": out_of_fold(),
    "e4_goal_means": goal_columns(False),
    "e5_goal_differences": goal_columns(True),
    "t1_tokens": over(DOCS, f"SELECT id, len(t)::INTEGER AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT id, {tokens('text')} AS t FROM docs)"),
    "t2_vocabulary": over(DOCS + ", " + vocab_views("docs"), "SELECT term, df FROM vocab"),
    "t3_term_counts": over(DOCS + ", " + term_views("docs"), "SELECT id, term, tf FROM counts"),
    "t4_tfidf": over(DOCS + ", " + vocab_views("docs") + ", " + weight_views(), f"SELECT id, term, {r6('w', 'w')} FROM weights"),
    "t5_naive_bayes": NAIVE_BAYES,
    "t6_out_of_fold_naive_bayes": OUT_OF_FOLD_BAYES,
    "t9_sentiment": SENTIMENT,
    "m6_least_squares_line": over(STATIC, f"SELECT {r6('regr_slope(y, m_log_goal)', 'slope')}, {r6('regr_intercept(y, m_log_goal)', 'intercept')} FROM static"),
    "m7_class_weights": over(V.CAMPAIGNS, f"SELECT y, {r6('(SELECT count(*) FROM campaigns) / (2.0 * count(*))', 'weight')} FROM campaigns GROUP BY y"),
    "m8_scaler_moments": over(STATIC, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'std')} FROM static" for c in Q.LINEAR)),
    "g2_mcnemar": over(pair_cells(Q.MODEL_PAIRS), f"SELECT A, B, a_only, b_only, {r6('mcnemar_p', 'mcnemar_p')} FROM tested"),
    "g4_planned_comparisons": over(pair_cells(PLANNED), f"SELECT A, B, n, {r6('(a_only - b_only) / n::DOUBLE', 'acc_diff')} FROM pairs"),
}
