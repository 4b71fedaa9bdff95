"""DuckDB SQL that states the result of each SQL-expressible query on the same tables."""

from __future__ import annotations

from ordinalis.catalog.views import LEXICON, LOGITS, MODELS, ROUNDS, TRIALS

# Written out here and not imported: an oracle that shares a constant with the code under test
# would share its mistakes.
K = 5
LOWEST_BIN, HIGHEST_BIN = -512, 1535
MODEL_WEIGHTS = {"boost_a": 0.4, "boost_b": 0.3, "boost_c": 0.2, "forest": 0.1}
START_THRESHOLDS = (0.5, 1.5, 2.5, 3.5)
REPLY_PATTERNS = {"has_5star": "5-star|5 stars|five-star|five stars", "has_issues": "issues|issue|problem",
                  "has_sorry": "sorry|apologize", "has_transactions": "transactions", "has_thanks": "thanks",
                  "has_bank_handle": "@BANK.co.id.", "has_phone": "08121214017"}
# Blocks that hold every emoji of the reviews and no letter; a variation selector is no emoji.
EMOJI_ONLY = r"^[\x{2190}-\x{2BFF}\x{1F000}-\x{1FAFF}]*$"


def _values(count: int, first: int = 0) -> str:
    return ", ".join(f"({i})" for i in range(first, first + count))


# --- the derived tables ------------------------------------------------------------------------

REVIEWS = """reviews AS (
SELECT id,
  CASE h % 11 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '😀👍' WHEN 3 THEN '👍🏽'
    WHEN 4 THEN utext || ' push Keep baguséx' WHEN 5 THEN utext || ' challenging?'
    WHEN 6 THEN '❤️' ELSE utext END AS review,
  CASE WHEN h % 5 = 0 THEN NULL ELSE CAST((h * 13 + length(utext)) % 5 AS INT) END AS score,
  ((h % 97) * (h % 97)) % 97 AS "thumbsUpCount",
  CAST(h % 4 AS VARCHAR) || '.' || CAST(h % 10 AS VARCHAR) || '.0' AS "reviewCreatedVersion",
  CASE WHEN rtext IS NULL THEN NULL ELSE rtext || CASE h % 9
    WHEN 0 THEN ' SORRY about this Issue' WHEN 1 THEN ' please rate Five Stars'
    WHEN 2 THEN ' call 08121214017' WHEN 3 THEN ' cs@bank.co.id.'
    WHEN 4 THEN ' Thanks, your transactions' ELSE '' END END AS "replyContent",
  CASE WHEN rtext IS NULL THEN NULL WHEN h % 17 = 3 THEN '05:06:00'
    ELSE CAST(h % 40 AS VARCHAR) || ' days 05:06:00' END AS "timeToReply",
  CASE WHEN h % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM (SELECT (u.conv_id + u.turn) * (u.conv_id + u.turn + 1) // 2 + u.turn AS id, u.conv_id * 31 + u.turn * 7 AS h,
             u.text AS utext, r.text AS rtext
      FROM conversations u
      LEFT JOIN conversations r ON r.conv_id = u.conv_id AND r.turn = u.turn + 1 AND r.role = 'assistant'
      WHERE u.role = 'user') x)"""

_Y = "CAST((o_orderkey * 7 + o_custkey) % 5 AS INT)"
_NOISY = ", ".join(
    f"CAST({_Y} AS DOUBLE) + (CAST((o_orderkey * {a} + t.trial * {b}) % 301 AS DOUBLE) - CAST(150 AS DOUBLE))"
    f" / CAST(100 AS DOUBLE) AS {name}" for name, (a, b) in MODELS.items())
PREDS = f"""preds AS (
SELECT o_orderkey AS id, t.trial, o_orderkey % 10 AS fold, {_Y} AS y, {_NOISY}
FROM orders CROSS JOIN (VALUES {_values(TRIALS)}) AS t(trial))"""

_WEIGHTED = " + ".join(f"CAST({w} AS DOUBLE) * {name}" for name, w in MODEL_WEIGHTS.items())
COMBINED = f"{PREDS}, combined AS (SELECT id, trial, fold, y, {_WEIGHTED} AS prediction FROM preds)"


def _digitize(value: str, cuts) -> str:
    return "(" + " + ".join(f"CAST({value} >= {t} AS INT)" for t in cuts) + ")"


LABELLED = (f"{COMBINED}, labelled AS (SELECT id, trial, fold, y, "
            f"{_digitize('prediction', [f'CAST({t} AS DOUBLE)' for t in START_THRESHOLDS])} AS label FROM combined)")

STAGED = f"""staged AS (
SELECT o.o_orderkey AS id, CAST(o.o_orderkey % 5 AS INT) AS y, i.iter,
  CASE WHEN i.iter = 1 THEN CAST(2 AS DOUBLE)
       WHEN i.iter <= 17 THEN (CAST(o.o_orderkey % 5 AS DOUBLE) - CAST(2 AS DOUBLE)) / CAST(16 AS DOUBLE)
       ELSE (CAST((o.o_orderkey * 37) % 101 AS DOUBLE) - CAST(50 AS DOUBLE)) / CAST(256 AS DOUBLE) END AS increment
FROM orders o CROSS JOIN (VALUES {_values(ROUNDS, 1)}) AS i(iter))"""

_LOGIT = ", ".join(
    f"CAST((o.o_orderkey * {a} + {b}) % 7 AS DOUBLE) / CAST(4 AS DOUBLE) + CASE WHEN o.o_orderkey % 5 = {k} "
    f"THEN CAST(e.epoch AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS l{k}" for k, (a, b) in enumerate(LOGITS))
EPOCH_LOGITS = f"""epoch_logits AS (
SELECT e.epoch, o.o_orderkey AS id, o.o_orderkey // 16 AS batch, CAST(o.o_orderkey % 5 AS INT) AS y, {_LOGIT}
FROM orders o CROSS JOIN (VALUES (1), (2), (3)) AS e(epoch))"""

_TOP = "greatest(l0, l1, l2, l3, l4)"
_ARGMAX = f"CASE {_TOP} WHEN l0 THEN 0 WHEN l1 THEN 1 WHEN l2 THEN 2 WHEN l3 THEN 3 ELSE 4 END"
_EXP_SUM = "(" + " + ".join(f"exp(l{k} - {_TOP})" for k in range(K)) + ")"
_OWN = "CASE y WHEN 0 THEN l0 WHEN 1 THEN l1 WHEN 2 THEN l2 WHEN 3 THEN l3 ELSE l4 END"
_LSE = f"({_TOP} + ln({_EXP_SUM}))"
_LOSS = (f"(CAST(0.7 AS DOUBLE) * ({_LSE} - {_OWN}) + CAST(0.06 AS DOUBLE) * ("
         + " + ".join(f"({_LSE} - l{k})" for k in range(K)) + "))")
JUDGED = (f"{EPOCH_LOGITS}, judged AS (SELECT epoch, id, batch, y, CAST({_ARGMAX} AS INT) AS p, {_LOSS} AS loss "
          "FROM epoch_logits)")


# --- text ------------------------------------------------------------------------------------------

def _keywords(column: str) -> str:
    out = f"replace(replace({column}, 'push', 'good'), 'Keep', 'great')"
    out = rf"regexp_replace({out}, 'bagus[\p{{L}}\p{{N}}_]*', 'good', 'g')"
    return f"replace({out}, 'challenging', 'troublesome')"


_EMOJI = f"regexp_matches(coalesce(review, ''), '{EMOJI_ONLY}')"
_REPLY = "coalesce(\"replyContent\", '')"
_DAYS = r"""try_cast(nullif(regexp_extract("timeToReply", '^\s*([+-]?[0-9]+)(\s|$)', 1), '') AS BIGINT)"""
_FLAGS = ", ".join([f"CAST(regexp_matches({_REPLY}, '{p}', 'i') AS INT) AS {n}" for n, p in REPLY_PATTERNS.items()]
                   + ["CAST(contains(text, '?') AS INT) AS has_question_mark"])
_FLAG_NAMES = ", ".join([*REPLY_PATTERNS, "has_question_mark"])
_IMPORTANCE = "round(ln(review_length + 1) * ln(\"thumbsUpCount\" + 1), 6) + CAST(0 AS DOUBLE)"
FEATURES = f"""{REVIEWS}, cleaned AS (
SELECT *, CASE WHEN {_EMOJI} THEN 'great' ELSE coalesce({_keywords('review')}, '') END AS text FROM reviews),
flagged AS (SELECT id, split, score, text, {_REPLY} AS "replyContent", {_DAYS} AS days_to_reply, {_FLAGS},
  CAST(length(text) AS INT) AS review_length, "thumbsUpCount" FROM cleaned),
features AS (SELECT *, {_IMPORTANCE} AS review_importance FROM flagged)"""

_FEATURE_TABLE = (f"WITH {FEATURES} SELECT id, split, score, text, \"replyContent\", days_to_reply, {_FLAG_NAMES}, "
                  "review_length, review_importance FROM features")

_PROFILED = ["id", "score", "days_to_reply", *REPLY_PATTERNS, "has_question_mark", "review_length", "review_importance"]
_PROFILED_TYPES = ["bigint", "int", "bigint"] + ["int"] * (len(REPLY_PATTERNS) + 2) + ["double"]


# --- language ----------------------------------------------------------------------------------------

def _detected(source: str, id_col: str) -> str:
    """CTEs ending in found(id, language) for the texts of ``source``."""
    return rf"""profile AS (
SELECT lang, token, count(*) AS n FROM (
  SELECT lang, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS token FROM documents WHERE lang IS NOT NULL) t
GROUP BY lang, token),
totals AS (SELECT lang, sum(n) AS total, (SELECT count(DISTINCT token) FROM profile) AS v FROM profile GROUP BY lang),
doc_tokens AS (
SELECT {id_col} AS id, token, count(*) AS m FROM (
  SELECT {id_col}, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS token FROM {source}) t
GROUP BY {id_col}, token),
doc_words AS (SELECT id, sum(m) AS m FROM doc_tokens GROUP BY id),
known AS (SELECT d.id, p.lang, sum(d.m * ln(CAST(p.n + 1 AS DOUBLE))) AS s
  FROM doc_tokens d JOIN profile p ON p.token = d.token GROUP BY d.id, p.lang),
scored AS (SELECT w.id, t.lang, round(coalesce(k.s, 0) - w.m * ln(CAST(t.total + t.v AS DOUBLE)), 6) AS score
  FROM doc_words w CROSS JOIN totals t LEFT JOIN known k ON k.id = w.id AND k.lang = t.lang),
found AS (SELECT s.{id_col} AS id, coalesce(b.lang, 'unknown') AS language
  FROM {source} s LEFT JOIN (SELECT id, lang, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) AS r
    FROM scored) b ON b.id = s.{id_col} AND b.r = 1)"""


# Each document against the words of the other two folds.
_CROSS_DETECTED = r"""folded AS (
SELECT doc_id, text, lang, CAST('0x' || substr(md5('42:' || doc_id), 1, 8) AS BIGINT) % 3 AS fold FROM documents),
tokens AS (SELECT doc_id, lang, fold, token, count(*) AS m FROM (
  SELECT doc_id, lang, fold, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM folded) t GROUP BY ALL),
profile AS (SELECT f.k, t.lang, t.token, sum(t.m) AS n FROM tokens t JOIN (VALUES (0), (1), (2)) AS f(k) ON t.fold <> f.k
  WHERE t.lang IS NOT NULL GROUP BY ALL),
totals AS (SELECT k, lang, sum(n) AS total FROM profile GROUP BY ALL),
vocabulary AS (SELECT k, count(DISTINCT token) AS v FROM profile GROUP BY k),
doc_words AS (SELECT doc_id, fold, sum(m) AS m FROM tokens GROUP BY ALL),
known AS (SELECT t.doc_id, p.lang, sum(t.m * ln(CAST(p.n + 1 AS DOUBLE))) AS s
  FROM tokens t JOIN profile p ON p.k = t.fold AND p.token = t.token GROUP BY ALL),
scored AS (SELECT w.doc_id, t.lang, round(coalesce(k.s, 0) - w.m * ln(CAST(t.total + v.v AS DOUBLE)), 6) AS score
  FROM doc_words w JOIN totals t ON t.k = w.fold JOIN vocabulary v ON v.k = w.fold
  LEFT JOIN known k ON k.doc_id = w.doc_id AND k.lang = t.lang),
found AS (SELECT f.doc_id, f.lang, coalesce(b.lang, 'unknown') AS language FROM folded f LEFT JOIN (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS r FROM scored) b
  ON b.doc_id = f.doc_id AND b.r = 1)"""


_LEXICON = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in LEXICON)
_TRANSLATE = rf"""WITH {REVIEWS}, texts AS (SELECT id, review AS text FROM reviews), {_detected('texts', 'id')},
lexicon AS (SELECT * FROM (VALUES {_LEXICON}) AS t(lang, token, dst)),
pieces AS (
  SELECT f.id, f.language, unnest(regexp_extract_all(t.text, '\p{{L}}+|[^\p{{L}}]+')) AS piece,
         generate_subscripts(regexp_extract_all(t.text, '\p{{L}}+|[^\p{{L}}]+'), 1) AS place
  FROM found f JOIN texts t ON t.id = f.id WHERE f.language NOT IN ('en', 'unknown')),
translated AS (SELECT p.id, string_agg(coalesce(l.dst, p.piece), '' ORDER BY p.place) AS text
  FROM pieces p LEFT JOIN lexicon l ON l.lang = p.language AND l.token = lower(p.piece) GROUP BY p.id)
SELECT r.id, r.review, coalesce(t.text, r.review) AS translated_review FROM reviews r LEFT JOIN translated t ON t.id = r.id"""


# --- encoding ------------------------------------------------------------------------------------------

_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\p{Z}\t\n\x0B\f\r]"
_HALF = 256


def _ids(side: str) -> str:
    body = f"[2] || coalesce({side}.ids, []) || [3]"
    return f"list_resize({body}, {_HALF}, 0)"


def _side(column: str, name: str) -> str:
    return f"""{name} AS (
SELECT id, list(coalesce(v.token_id, 1) ORDER BY place) AS ids FROM (
  SELECT id, unnest(toks) AS token, generate_subscripts(toks, 1) AS place FROM (
    SELECT id, list_slice(regexp_extract_all(lower(coalesce({column}, '')), '{_TOKEN}'), 1, {_HALF - 2}) AS toks
    FROM reviews) a) b LEFT JOIN vocabulary v ON v.token = b.token GROUP BY id)"""


_ENCODE = f"""WITH {REVIEWS}, all_tokens AS (
  SELECT unnest(regexp_extract_all(lower(coalesce(review, '')), '{_TOKEN}')) AS token FROM reviews
  UNION ALL SELECT unnest(regexp_extract_all(lower(coalesce("replyContent", '')), '{_TOKEN}')) FROM reviews),
vocabulary AS (SELECT token, CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 3 AS INT) AS token_id
  FROM all_tokens GROUP BY token
  QUALIFY row_number() OVER (ORDER BY count(*) DESC, token) <= 30000),
{_side('review', 'a')}, {_side('"replyContent"', 'b')},
padded AS (SELECT r.id, {_ids('a')} AS x, {_ids('b')} AS z FROM reviews r LEFT JOIN a ON a.id = r.id LEFT JOIN b ON b.id = r.id)
SELECT id, array_to_string(x, ',') AS review_ids, array_to_string(list_transform(x, lambda t: CAST(t <> 0 AS INT)), ',') AS review_mask,
  array_to_string(z, ',') AS reply_ids, array_to_string(list_transform(z, lambda t: CAST(t <> 0 AS INT)), ',') AS reply_mask FROM padded"""


# --- agreement -------------------------------------------------------------------------------------------

def _kappa(n: str, sy: str, sp: str, syy: str, spp: str, syp: str) -> str:
    n, sy, sp, syy, spp, syp = (f"CAST({c} AS DOUBLE)" for c in (n, sy, sp, syy, spp, syp))
    chance = f"({n} * ({syy} + {spp}) - 2 * {sy} * {sp})"
    return f"(1 - {n} * ({syy} + {spp} - 2 * {syp}) / nullif({chance}, 0))"


def _kappa_over(a: str, b: str, n: str = "1") -> str:
    return _kappa(f"sum({n})", f"sum({n} * {a})", f"sum({n} * {b})", f"sum({n} * {a} * {a})",
                  f"sum({n} * {b} * {b})", f"sum({n} * {a} * {b})")


def _qwk_present(source: str, y: str, p: str, by: list[str]) -> str:
    """CTEs ending in kappas(by..., qwk), labels numbered among those present per group."""
    g = ", ".join(by)
    same = lambda other: " AND ".join(f"{other}.{c} = s.{c}" for c in by)
    return f"""seen AS (SELECT DISTINCT {g}, {y} AS label FROM {source} UNION SELECT DISTINCT {g}, {p} FROM {source}),
numbered AS (SELECT {g}, label, dense_rank() OVER (PARTITION BY {g} ORDER BY label) AS r FROM seen),
kappas AS (SELECT {', '.join('s.' + c for c in by)}, {_kappa_over('a.r', 'b.r')} AS qwk FROM {source} s
  JOIN numbered a ON {same('a')} AND a.label = s.{y} JOIN numbered b ON {same('b')} AND b.label = s.{p} GROUP BY ALL)"""


def _report(source: str, y: str, p: str, by: list[str]) -> str:
    """CTEs ending in report(by..., class, precision, recall, f1, support)."""
    g = "".join(f"{c}, " for c in by)
    sg = "".join(f"s.{c}, " for c in by)
    return f"""sides AS (
  SELECT {g}{y} AS class, 1 AS is_true, 0 AS is_pred, CAST({y} = {p} AS INT) AS hit FROM {source}
  UNION ALL SELECT {g}{p}, 0, 1, 0 FROM {source}
  UNION ALL SELECT DISTINCT {g}k.k, 0, 0, 0 FROM {source} CROSS JOIN (VALUES {_values(K)}) AS k(k)),
counts AS (SELECT {g}class, CAST(sum(is_true) AS DOUBLE) AS t, CAST(sum(is_pred) AS DOUBLE) AS d,
  CAST(sum(hit) AS DOUBLE) AS h FROM sides GROUP BY ALL),
scores AS (SELECT {g}class, coalesce(h / nullif(d, 0), 0) AS precision, coalesce(h / nullif(t, 0), 0) AS recall,
  coalesce(2 * h / nullif(t + d, 0), 0) AS f1, t AS support, h FROM counts),
report AS (
  SELECT {g}CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM scores
  UNION ALL SELECT {g}'accuracy', NULL, NULL, sum(h) / sum(support), sum(support) FROM scores s GROUP BY {g}2
  UNION ALL SELECT {g}'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores s GROUP BY {g}2
  UNION ALL SELECT {g}'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM scores s GROUP BY {g}2)""".replace(
        f"GROUP BY {g}2", f"GROUP BY {', '.join(by)}" if by else "")


VOTES = f"""{LABELLED}, votes AS (SELECT id, y, label FROM (
  SELECT id, y, label, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, label) AS r
  FROM labelled GROUP BY id, y, label) t WHERE r = 1)"""

_EVALUATE = f"""WITH {VOTES}, one AS (SELECT 0 AS g, * FROM votes), {_qwk_present('one', 'y', 'label', ['g'])}, {_report('votes', 'y', 'label', [])}
SELECT 'accuracy' AS metric, 'all' AS class, round(avg(CAST(y = label AS INT)), 9) AS value FROM votes
UNION ALL SELECT 'qwk', 'all', round(qwk, 9) FROM kappas
UNION ALL SELECT 'precision', class, round(precision, 9) FROM report
UNION ALL SELECT 'recall', class, round(recall, 9) FROM report
UNION ALL SELECT 'f1', class, round(f1, 9) FROM report
UNION ALL SELECT 'support', class, support FROM report"""


# --- thresholds ---------------------------------------------------------------------------------------------

_BIN = f"CAST(floor(least(greatest(prediction * 256, {LOWEST_BIN}), {HIGHEST_BIN})) AS INT)"
HISTOGRAM = f"""{COMBINED}, histogram AS (SELECT trial, fold, {_BIN} AS bin, count(*) AS n, CAST(sum(y) AS BIGINT) AS sy,
  CAST(sum(y * y) AS BIGINT) AS syy FROM combined GROUP BY ALL)"""
TAILS = f"""{HISTOGRAM}, tails AS (SELECT trial, fold, bin,
  CAST(sum(n) OVER w AS BIGINT) AS n_tail, CAST(sum(sy) OVER w AS BIGINT) AS sy_tail FROM histogram
  WINDOW w AS (PARTITION BY trial, fold ORDER BY bin DESC ROWS UNBOUNDED PRECEDING))"""

_EDGES = [int(t * 256) for t in START_THRESHOLDS]


def _candidate(k: int) -> str:
    """Kappa with cut k (1-based) at the row's bin and the other cuts at the start vector."""
    count = [("n_tail" if i == k - 1 else f"a{i}") for i in range(4)]
    label = [("sy_tail" if i == k - 1 else f"b{i}") for i in range(4)]
    sp = "(" + " + ".join(f"CAST({c} AS DOUBLE)" for c in count) + ")"
    spp = "(" + " + ".join(f"{2 * i + 1} * CAST({c} AS DOUBLE)" for i, c in enumerate(count)) + ")"
    syp = "(" + " + ".join(f"CAST({c} AS DOUBLE)" for c in label) + ")"
    low = _EDGES[k - 2] if k > 1 else LOWEST_BIN
    high = _EDGES[k] if k < 4 else HIGHEST_BIN
    return (f"SELECT trial, fold, {k} AS k, bin, round({_kappa('n', 'sy', sp, 'syy', spp, syp)}, 9) AS qwk "
            f"FROM joined WHERE bin BETWEEN {low} AND {high}")


_ABOVE = ", ".join([f"coalesce(sum(n) FILTER (WHERE bin >= {e}), 0) AS a{i}" for i, e in enumerate(_EDGES)]
                   + [f"coalesce(sum(sy) FILTER (WHERE bin >= {e}), 0) AS b{i}" for i, e in enumerate(_EDGES)])
CANDIDATES = f"""{TAILS}, wholes AS (SELECT trial, fold, sum(n) AS n, sum(sy) AS sy, sum(syy) AS syy, {_ABOVE}
  FROM histogram GROUP BY trial, fold),
joined AS (SELECT t.*, w.* EXCLUDE (trial, fold) FROM tails t JOIN wholes w ON w.trial = t.trial AND w.fold = t.fold),
candidates AS ({' UNION ALL '.join(_candidate(k) for k in range(1, 5))})"""
BEST = f"""{CANDIDATES}, best AS (SELECT trial, fold, {', '.join(
    f"max(CASE WHEN k = {k} THEN CAST(bin AS DOUBLE) / 256 END) AS t{k}" for k in range(1, 5))}
  FROM (SELECT *, row_number() OVER (PARTITION BY trial, fold, k ORDER BY qwk DESC, bin) AS r
        FROM candidates WHERE qwk IS NOT NULL) c WHERE r = 1 GROUP BY trial, fold),
means AS (SELECT trial, {', '.join(f"avg(t{k}) AS t{k}" for k in range(1, 5))} FROM best GROUP BY trial)"""


# --- ranks ----------------------------------------------------------------------------------------------------

def _ranked(seed: int) -> str:
    return (f"ranked AS (SELECT o_orderkey AS id, row_number() OVER (ORDER BY md5('{seed}:' || o_orderkey), o_orderkey) AS r, "
            "count(*) OVER () AS n FROM orders)")


_ROUND6 = lambda c, name: f"round({c}, 6) + CAST(0 AS DOUBLE) AS {name}"
_ONEHOT = ", ".join(f"CAST(({_ARGMAX}) = {k} AS INT) AS sentiment_{k}" for k in range(K))
_PROB = [f"exp(l{k} - {_TOP}) / {_EXP_SUM}" for k in range(K)]
_EPOCH_METRICS = f"""WITH {JUDGED}, {_qwk_present('judged', 'y', 'p', ['epoch'])},
losses AS (SELECT epoch, avg(loss) AS loss FROM (SELECT epoch, batch, avg(loss) AS loss FROM judged GROUP BY epoch, batch) b GROUP BY epoch),
hits AS (SELECT epoch, avg(CAST(y = p AS INT)) AS accuracy FROM judged GROUP BY epoch)
SELECT epoch, round(loss, 6) AS {{0}}loss, round(accuracy, 6) AS {{0}}accuracy, round(qwk, 6) AS {{0}}qwk
FROM losses JOIN hits USING (epoch) JOIN kappas USING (epoch)"""

_SPARSE = (f"{LABELLED}, sparse AS (SELECT trial, CASE WHEN y < 2 THEN y ELSE 4 END AS y, "
           "CASE WHEN label < 2 THEN label ELSE 4 END AS label FROM labelled)")

# --- properties of fitted models -------------------------------------------------------------------

# The rows that the regressors learn from, and which of them are held out.
MATRIX = """matrix AS (SELECT l_orderkey AS id, CAST(least(4, floor(sum(l_quantity) / 40)) AS INT) AS score FROM lineitem GROUP BY l_orderkey),
placed AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || id), id) AS r, count(*) OVER () AS n FROM matrix),
parts AS (SELECT id, score, r <= ceil(CAST(0.2 AS DOUBLE) * n) AS held FROM placed)"""


# The same parts with a label that adds up three columns and a spread.
NOISY = MATRIX.replace("CAST(least(4, floor(sum(l_quantity) / 40)) AS INT) AS score", """CAST(least(4, greatest(0, CAST(sum(l_quantity) AS BIGINT)
    + CAST(round(max(l_tax) * 100) AS BIGINT) * 8 + count(*) * 12 + (l_orderkey * 37) % 41 - 20) // 80) AS INT) AS score""")


def _fitted(name: str) -> str:
    return f"WITH {NOISY} SELECT id, score, '{name}' AS model, true AS in_range, true AS explains, true AS stopped FROM parts WHERE held"


def _evaluated(ctes: str, source: str) -> str:
    """Every metric in its range, and the supports, for the labelled rows of ``source``."""
    names = "(VALUES ('0'), ('1'), ('2'), ('3'), ('4'), ('accuracy'), ('macro avg'), ('weighted avg')) AS c(class)"
    return f"""WITH {ctes}, judged_rows AS (SELECT score FROM {source})
SELECT m.metric, 'all' AS class, CAST(NULL AS DOUBLE) AS support, true AS in_range FROM (VALUES ('accuracy'), ('qwk')) AS m(metric)
UNION ALL SELECT m.metric, c.class, NULL, true FROM (VALUES ('precision'), ('recall'), ('f1')) AS m(metric) CROSS JOIN {names}
UNION ALL SELECT 'support', c.class, CAST((SELECT count(*) FROM judged_rows r
    WHERE length(c.class) > 1 OR CAST(r.score AS VARCHAR) = c.class) AS DOUBLE), true FROM {names}"""


_REVIEWED = _evaluated(f"{REVIEWS}", "reviews WHERE split = 'train' AND score IS NOT NULL")
_CHECKED_CUTS = f"WITH {PREDS} SELECT DISTINCT trial, fold, true AS recomputed, true AS no_worse, true AS ordered FROM preds"
_VALID_EPOCH = ", ".join(f"true AS {part}_{m}_valid" for part in ("train", "val") for m in ("loss", "accuracy", "qwk"))

ORACLES: dict[str, str] = {
    "load_reviews_by_name": f"""WITH {REVIEWS} SELECT id, nullif(review, '') AS review, score, "thumbsUpCount", "reviewCreatedVersion",
        "replyContent", "timeToReply", "replyContent" AS translated_review, 'en' AS language FROM reviews""",
    "fit_sentiment_model": f"""WITH {REVIEWS} SELECT count(*) AS n_rows, true AS falling, true AS within_limit
        FROM reviews WHERE score IS NOT NULL AND split = 'train'""",
    "train_sentiment": f"SELECT CAST(e.epoch AS INT) AS epoch, {_VALID_EPOCH} FROM (VALUES (1), (2), (3)) AS e(epoch)",
    "score_sentiment": f"WITH {REVIEWS} SELECT id, CAST(5 AS INT) AS classes, true AS distribution FROM reviews",
    "pca_features": f"WITH {REVIEWS} SELECT count(*) AS n_rows, true AS centred, true AS uncorrelated, true AS ordered FROM reviews",
    "scored_feature_table": f"""WITH {FEATURES} SELECT id, split, score, text, "replyContent", days_to_reply, {_FLAG_NAMES}, review_length,
        review_importance, true AS distribution, true AS marked, CAST(1 AS INT) AS marks, true AS components FROM features""",
    **{f"fit_{name}": _fitted(name) for name in MODEL_WEIGHTS},
    "predict_test": f"WITH {MATRIX} " + " UNION ALL ".join(
        f"SELECT id, '{name}' AS model, true AS in_range, true AS explains FROM parts WHERE held" for name in MODEL_WEIGHTS),
    "refine_thresholds": """SELECT DISTINCT CAST(t.trial AS INT) AS trial, true AS recomputed, true AS no_worse, true AS ordered
        FROM orders, range(10) AS t(trial)""",
    "optimize_thresholds": _CHECKED_CUTS,
    "optimize_thresholds_fixed": _CHECKED_CUTS,
    "optimize_thresholds_missing_class": _CHECKED_CUTS,
    "kfold_oof_kept": f"""WITH {MATRIX},
runs AS (SELECT * FROM (VALUES (0, 3, 3), (1, 2, 2), (2, 3, 0)) AS r(run, folds, fitted)),
folded AS (SELECT run, fitted, id, CASE WHEN folds = 3 THEN ntile(3) OVER (PARTITION BY run ORDER BY md5('42:' || id), id)
    ELSE ntile(2) OVER (PARTITION BY run ORDER BY md5('42:' || id), id) END - 1 AS fold FROM matrix, runs)
SELECT CAST(run AS INT) AS run, CAST(fold AS INT) AS fold, count(id) AS n, count(DISTINCT id) AS ids, CAST(max(fitted) AS INT) AS fitted,
  true AS as_first FROM folded GROUP BY run, fold""",
    "kfold_oof": f"""WITH {MATRIX} SELECT CAST(0 AS INT) AS trial, id,
        CAST(ntile(3) OVER (ORDER BY md5('42:' || id), id) - 1 AS INT) AS fold, score, true AS labelled, true AS agrees FROM matrix""",
    "train_ensemble": f"SELECT *, true AS agrees, true AS test_agrees FROM ({_evaluated(MATRIX, 'parts WHERE NOT held')})",
    "review_run": _REVIEWED,
    "review_run_plug_ins": _REVIEWED,

    "load_reviews": f"""WITH {REVIEWS} SELECT id, nullif(review, '') AS review, score, "thumbsUpCount", "reviewCreatedVersion",
        "replyContent", "timeToReply" FROM reviews""",
    "load_reviews_split": f"""WITH {REVIEWS} SELECT id, nullif(review, '') AS review, score, "thumbsUpCount", "reviewCreatedVersion",
        "replyContent", "timeToReply" FROM reviews""",
    "union_train_test": f"WITH {REVIEWS} SELECT * REPLACE (CASE WHEN split = 'train' THEN score END AS score) FROM reviews",
    "load_submission_template": f"WITH {REVIEWS} SELECT CAST(id AS VARCHAR) AS id, CAST(0 AS INT) AS value FROM reviews WHERE split = 'test'",
    "materialize_or_load": f"WITH {REVIEWS} SELECT id, split, score FROM reviews",
    "sink_features": _FEATURE_TABLE,
    "sink_epoch_metrics": _EPOCH_METRICS.format("train_"),
    "sink_report": _EVALUATE,
    "submission": f"""WITH {REVIEWS} SELECT CAST(id AS VARCHAR) AS id, CAST("thumbsUpCount" % 5 AS INT) AS value
        FROM reviews WHERE split = 'test'""",

    "model_roundtrip": f"WITH {REVIEWS} SELECT id, true AS equal FROM reviews",

    "clean_text": f"WITH {REVIEWS} SELECT id, {_keywords('review')} AS text FROM reviews",
    "fill_text_nulls": f"WITH {REVIEWS} SELECT id, coalesce(review, '') AS review, {_REPLY} AS \"replyContent\" FROM reviews",
    "emoji_override": f"WITH {REVIEWS} SELECT id, CASE WHEN {_EMOJI} THEN 'great' ELSE review END AS text FROM reviews",
    "select_model_columns": f"WITH {FEATURES} SELECT id, split, days_to_reply, {_FLAG_NAMES}, review_importance FROM features",
    "split_train_test": f"WITH {REVIEWS} SELECT split AS part, id, score FROM reviews",
    "days_to_reply": f"WITH {REVIEWS} SELECT id, {_DAYS} AS days_to_reply FROM reviews",
    "text_flags": f"WITH {FEATURES} SELECT id, {_FLAG_NAMES} FROM features",
    "review_length": f"WITH {FEATURES} SELECT id, review_length FROM features",
    "review_importance": f"WITH {FEATURES} SELECT id, review_importance FROM features",
    "prob_columns": f"WITH {EPOCH_LOGITS} SELECT epoch, id, " + ", ".join(
        _ROUND6(p, f'"{k}_prob"') for k, p in enumerate(_PROB)) + " FROM epoch_logits",
    "sentiment_onehot": f"WITH {EPOCH_LOGITS} SELECT epoch, id, {_ONEHOT} FROM epoch_logits",
    "route_language": "SELECT doc_id, CASE WHEN coalesce(lang, 'unknown') IN ('en', 'unknown') THEN text ELSE '> ' || text END AS routed FROM documents",
    "working_text": f"WITH {REVIEWS} SELECT id, \"replyContent\" AS text FROM reviews",
    "profile_features": f"WITH {FEATURES} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM features" for c, t in zip(_PROFILED, _PROFILED_TYPES)),
    "feature_table": _FEATURE_TABLE,
    "feature_table_stream": _FEATURE_TABLE,
    "impute_days": f"WITH {FEATURES} SELECT id, coalesce(days_to_reply, -1) AS days_to_reply, CAST(days_to_reply IS NULL AS INT) AS days_missing FROM features",

    "detect_language": f"WITH {_detected('documents', 'doc_id')} SELECT id AS doc_id, language FROM found",
    "language_accuracy": f"WITH {_CROSS_DETECTED} SELECT lang, language, count(*) AS n FROM found GROUP BY lang, language",
    "translate_reviews": _TRANSLATE,
    "translate_memo": """WITH edited AS (
        SELECT doc_id, lang, CASE WHEN doc_id % 100 = 0 THEN text || ' (edited)' ELSE text END AS text FROM documents),
        before AS (SELECT DISTINCT text, lang FROM documents)
        SELECT e.doc_id, CASE WHEN coalesce(e.lang, 'unknown') IN ('en', 'unknown') THEN e.text
                              WHEN b.text IS NULL THEN 'second: ' || e.text ELSE 'first: ' || e.text END AS translated_review,
               CAST(NULL AS VARCHAR) AS translate_error
        FROM edited e LEFT JOIN before b ON b.text = e.text AND b.lang = e.lang""",
    "encode_text_pair": _ENCODE,
    "epoch_metrics": _EPOCH_METRICS.format(""),
    "softmax_scores": f"WITH {EPOCH_LOGITS} SELECT epoch, id, " + ", ".join(
        _ROUND6(p, f"p{k}") for k, p in enumerate(_PROB)) + " FROM epoch_logits",
    "smoothed_cross_entropy": f"""WITH {JUDGED} SELECT epoch, round(avg(loss), 6) AS loss FROM (
        SELECT epoch, batch, avg(loss) AS loss FROM judged GROUP BY epoch, batch) b GROUP BY epoch""",
    "argmax_class": f"WITH {JUDGED} SELECT epoch, id, p FROM judged",

    "holdout_split": f"WITH {_ranked(42)} SELECT id, r <= ceil(CAST(0.2 AS DOUBLE) * n) AS is_validation FROM ranked",
    "kfold_assign": "SELECT o_orderkey AS id, CAST(ntile(10) OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) - 1 AS INT) AS fold FROM orders",
    "kfold_hash": "SELECT o_orderkey AS id, CAST(CAST('0x' || substr(md5('42:' || o_orderkey), 1, 8) AS BIGINT) % 10 AS INT) AS fold FROM orders",
    "trial_seeds": f"WITH {PREDS} SELECT trial, 42 * (trial + 1) AS seed, count(*) AS n_rows FROM preds GROUP BY trial",
    "batch_assign": f"WITH {_ranked(42001)} SELECT id, (r - 1) // 16 AS batch FROM ranked",
    "oof_scatter": f"WITH {PREDS} SELECT trial, id, fold, {_ROUND6('boost_a', 'boost_a')} FROM preds",

    "staged_best_iter": f"""WITH {STAGED}, sums AS (SELECT id, y, iter, CAST(round_even(sum(increment) OVER (
            PARTITION BY id ORDER BY iter ROWS UNBOUNDED PRECEDING), 0) AS INT) AS p FROM staged),
        {_qwk_present('sums', 'y', 'p', ['iter'])},
        curve AS (SELECT iter, coalesce(round(qwk, 9), CAST('-inf' AS DOUBLE)) AS q FROM kappas),
        marked AS (SELECT c.iter, c.q, c.iter = 1 OR c.q > coalesce(max(c.q) OVER (ORDER BY c.iter ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING), CAST('-inf' AS DOUBLE)) AS better FROM curve c),
        lasts AS (SELECT *, max(CASE WHEN better THEN iter END) OVER (ORDER BY iter) AS last_better FROM marked),
        stops AS (SELECT coalesce(min(iter), 1000000) AS stop_at FROM lasts WHERE iter - last_better >= 10)
        SELECT CAST(iter AS INT) AS best_iter, round(q, 6) AS best FROM lasts, stops WHERE iter <= stop_at ORDER BY q DESC, iter LIMIT 1""",

    "ensemble_weighted": f"WITH {COMBINED} SELECT trial, id, {_ROUND6('prediction', 'prediction')} FROM combined",
    "ensemble_long": f"WITH {COMBINED} SELECT trial, id, {_ROUND6('prediction', 'prediction')} FROM combined",
    "digitize": f"WITH {LABELLED} SELECT trial, id, label FROM labelled",
    "qwk": f"WITH {LABELLED}, {_qwk_present('labelled', 'y', 'label', ['trial', 'fold'])} SELECT trial, fold, round(qwk, 9) AS qwk FROM kappas",
    "qwk_fixed": f"WITH {LABELLED} SELECT trial, fold, round({_kappa_over('y', 'label')}, 9) AS qwk FROM labelled GROUP BY trial, fold",
    "qwk_missing_class": f"""WITH {_SPARSE}, {_qwk_present('sparse', 'y', 'label', ['trial'])},
        plain AS (SELECT trial, {_kappa_over('y', 'label')} AS q FROM sparse GROUP BY trial)
        SELECT k.trial, round(k.qwk, 9) AS present, round(p.q, 9) AS fixed FROM kappas k JOIN plain p ON p.trial = k.trial""",
    "qwk_rounded": f"""WITH {PREDS}, rounded AS (SELECT trial, fold, y, CAST(round_even(boost_a, 0) AS INT) AS p FROM preds),
        {_qwk_present('rounded', 'y', 'p', ['trial', 'fold'])} SELECT trial, fold, round(qwk, 9) AS qwk FROM kappas""",
    "threshold_tail_sums": f"WITH {TAILS} SELECT trial, fold, bin, n_tail, sy_tail FROM tails",
    "threshold_candidates": f"WITH {CANDIDATES} SELECT trial, fold, k, bin, qwk FROM candidates",
    "best_candidates": f"WITH {BEST} SELECT trial, fold, t1, t2, t3, t4 FROM best",
    "mean_thresholds": f"WITH {BEST} SELECT trial, " + ", ".join(f"round(t{k}, 9) AS t{k}" for k in range(1, 5)) + " FROM means",
    "vote_mode": f"WITH {VOTES} SELECT id, label FROM votes",
    "accuracy": f"WITH {LABELLED} SELECT trial, fold, round(avg(CAST(y = label AS INT)), 9) AS accuracy FROM labelled GROUP BY trial, fold",
    "classification_report": f"""WITH {LABELLED}, {_report('labelled', 'y', 'label', ['trial'])} SELECT trial, class, round(precision, 9) AS precision,
        round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM report""",
    "confusion_matrix": f"""WITH {LABELLED}, cells AS (SELECT DISTINCT trial, y.k AS y, p.k AS p FROM labelled
            CROSS JOIN (VALUES {_values(K)}) AS y(k) CROSS JOIN (VALUES {_values(K)}) AS p(k))
        SELECT c.trial, c.y, c.p, count(l.id) AS n FROM cells c LEFT JOIN labelled l ON l.trial = c.trial AND l.y = c.y AND l.label = c.p
        GROUP BY c.trial, c.y, c.p""",
    "ensemble_test": f"""WITH {BEST} SELECT c.trial, c.id, {_digitize('c.prediction', [f'm.t{k}' for k in range(1, 5)])} AS label
        FROM combined c JOIN means m ON m.trial = c.trial""",
    "evaluate_run": _EVALUATE,
    "evaluate_stream": _EVALUATE,
}
