"""SQL that checks the scores over stemmed words: suffix stripping step by step over distinct words, and
METEOR's stages as joins of words with their number from the end of the text."""

from __future__ import annotations

from cataloom.functions.stem import STEP_2, STEP_3, STEP_4
from cataloom.functions.text import WHITE_SPACE
from cataloom.operators.similarity import ALPHA, BETA, GAMMA, STEM_LONGER_THAN

from . import views

# One letter per character of ``w``, ``c`` for consonants and ``v`` for vowels, in the column ``sh``.
SHAPED = """list_reduce(list_prepend('', regexp_extract_all(w, '(?s).')), lambda done, x:
    done || CASE WHEN x IN ('a', 'e', 'i', 'o', 'u') OR (x = 'y' AND done[-1] = 'c') THEN 'v' ELSE 'c' END)"""


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'vc', ''))) // 2)"


def _cvc(word: str, shape: str) -> str:
    return f"(ends_with({shape}, 'cvc') AND right({word}, 1) NOT IN ('w', 'x', 'y'))"


def _longest(suffixes) -> str:
    # The leftmost match that reaches the end of the word is the longest suffix.
    return f"regexp_extract(w, '({'|'.join(suffixes)})$')"


def _replaced(table: dict[str, str]) -> str:
    pairs = ", ".join(f"'{old}': '{new}'" for old, new in table.items())
    rest = "left(sh, length(w) - length(suffix))"
    return f"""SELECT term, CASE WHEN suffix <> '' AND {_measure(rest)} > 0
    THEN left(w, length(w) - length(suffix)) || MAP {{{pairs}}}[suffix] ELSE w END AS w
  FROM (SELECT *, {SHAPED} AS sh, {_longest(table)} AS suffix FROM PREVIOUS)"""


def stems_sql(terms: str) -> str:
    """CTEs that end in ``stems(term, stem)`` of the distinct ``term`` of the relation ``terms``."""
    rest, whole = "left(sh, length(w) - length(suffix))", "sh"
    steps = [
        """SELECT term, CASE WHEN ends_with(term, 'sses') OR ends_with(term, 'ies') THEN left(term, -2)
    WHEN ends_with(term, 's') AND NOT ends_with(term, 'ss') THEN left(term, -1) ELSE term END AS w
  FROM PREVIOUS WHERE length(term) > 2""",
        f"""SELECT term, CASE WHEN suffix = 'eed' AND {_measure(rest)} > 0 THEN left(w, -1)
    WHEN suffix IN ('ed', 'ing') AND contains({rest}, 'v') THEN left(w, length(w) - length(suffix)) ELSE w END AS w,
    suffix IN ('ed', 'ing') AND contains({rest}, 'v') AS cut
  FROM (SELECT *, {SHAPED} AS sh, {_longest(["eed", "ed", "ing"])} AS suffix FROM PREVIOUS)""",
        f"""SELECT term, CASE WHEN NOT cut THEN w
    WHEN right(w, 2) IN ('at', 'bl', 'iz') THEN w || 'e'
    WHEN length(w) > 1 AND w[-1] = w[-2] AND sh[-1] = 'c' THEN CASE WHEN w[-1] IN ('l', 's', 'z') THEN w ELSE left(w, -1) END
    WHEN {_measure(whole)} = 1 AND {_cvc("w", "sh")} THEN w || 'e' ELSE w END AS w
  FROM (SELECT *, {SHAPED} AS sh FROM PREVIOUS)""",
        f"""SELECT term, CASE WHEN ends_with(w, 'y') AND contains(left(sh, -1), 'v') THEN left(w, -1) || 'i' ELSE w END AS w
  FROM (SELECT *, {SHAPED} AS sh FROM PREVIOUS)""",
        _replaced(STEP_2),
        _replaced(STEP_3),
        f"""SELECT term, CASE WHEN suffix <> '' AND {_measure(rest)} > 1
    AND (suffix <> 'ion' OR w[-4] IN ('s', 't')) THEN left(w, length(w) - length(suffix)) ELSE w END AS w
  FROM (SELECT *, {SHAPED} AS sh, {_longest(STEP_4)} AS suffix FROM PREVIOUS)""",
        f"""SELECT term, CASE WHEN ends_with(w, 'e') AND ({_measure("left(sh, -1)")} > 1
    OR ({_measure("left(sh, -1)")} = 1 AND NOT {_cvc("left(w, -1)", "left(sh, -1)")})) THEN left(w, -1) ELSE w END AS w
  FROM (SELECT *, {SHAPED} AS sh FROM PREVIOUS)""",
        f"""SELECT term, CASE WHEN ends_with(w, 'll') AND {_measure(whole)} > 1 THEN left(w, -1) ELSE w END AS stem
  FROM (SELECT *, {SHAPED} AS sh FROM PREVIOUS)
  UNION ALL SELECT term, term FROM (SELECT DISTINCT term FROM {terms}) WHERE length(term) <= 2""",
    ]
    names = [f"(SELECT DISTINCT term FROM {terms})"] + [f"stem_step_{i}" for i in range(1, len(steps))] + ["stems"]
    return ",\n".join(
        f"{name} AS MATERIALIZED (\n  {step.replace('PREVIOUS', before)}\n)"
        for before, name, step in zip(names, names[1:], steps, strict=False)
    )


# Places and words of both sides (0 reference, 1 candidate) of ``pairs(pair_id, reference, candidate)``, stemmed.
STEMMED_TOKENS_SQL = f"""
stem_lists AS (
  SELECT pair_id, 0 AS side, regexp_extract_all(lower(reference), '[a-z0-9]+') AS words FROM pairs
  UNION ALL SELECT pair_id, 1, regexp_extract_all(lower(candidate), '[a-z0-9]+') FROM pairs
),
stem_words AS (SELECT pair_id, side, unnest(words) AS term, unnest(range(1, len(words) + 1)) AS i FROM stem_lists),
{stems_sql("stem_words")},
stem_tokens AS (
  SELECT pair_id, side, i, CASE WHEN length(term) > {STEM_LONGER_THAN} THEN stem ELSE term END AS word
  FROM stem_words JOIN stems USING (term)
),
lengths AS (
  SELECT pair_id, count(*) FILTER (side = 0) AS n_r, count(*) FILTER (side = 1) AS n_c FROM stem_words GROUP BY 1
)"""


def stemmed_rouge_sql(n: int) -> str:
    """CTE ``rouge{n}_scores(pair_id, score)``."""
    grams = (
        "SELECT pair_id, side, word AS gram FROM stem_tokens"
        if n == 1
        else "SELECT a.pair_id, a.side, a.word || ' ' || b.word AS gram FROM stem_tokens a "
        "JOIN stem_tokens b ON b.pair_id = a.pair_id AND b.side = a.side AND b.i = a.i + 1"
    )
    return f"""
rouge{n}_scores AS (
  SELECT pair_id, coalesce(2.0 * sum(least(a, b)) / sum(a + b), 0.0) AS score FROM pairs LEFT JOIN (
    SELECT pair_id, gram, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM ({grams}) GROUP BY 1, 2
  ) USING (pair_id) GROUP BY 1
)"""


# The table of common subsequences row by row, over the stemmed words.
STEMMED_LCS_SQL = """
lcs_grid(pair_id, i, j, best) AS (
  SELECT pair_id, 0::BIGINT, i, 0 FROM stem_tokens WHERE side = 1
  UNION ALL
  SELECT pair_id, i, j, max(found) OVER (PARTITION BY pair_id ORDER BY j) FROM (
    SELECT g.pair_id, g.i + 1 AS i, g.j,
      CASE WHEN c.word = r.word THEN 1 + lag(g.best, 1, 0) OVER (PARTITION BY g.pair_id ORDER BY g.j) ELSE g.best END AS found
    FROM lcs_grid g JOIN stem_tokens r ON r.pair_id = g.pair_id AND r.side = 0 AND r.i = g.i + 1
      JOIN stem_tokens c ON c.pair_id = g.pair_id AND c.side = 1 AND c.i = g.j)
),
rougeL_scores AS (
  SELECT pair_id, CASE WHEN max(best) > 0 THEN 2.0 * max(best) / any_value(n_r + n_c) ELSE 0.0 END AS score
  FROM pairs LEFT JOIN lengths USING (pair_id) LEFT JOIN lcs_grid USING (pair_id) GROUP BY 1
)"""


def _stage(name: str, before: str, key: str, join: str = "") -> str:
    """Words that are still free meet by key and number from the end; ``{name}_found`` are their places."""
    return f"""
{name}_free AS (
  SELECT w.*, {key} AS key, row_number() OVER (PARTITION BY pair_id, side, {key} ORDER BY i DESC) AS k
  FROM {before} w {join}
),
{name}_found AS (
  SELECT c.pair_id, c.i AS c_i, r.i AS r_i FROM {name}_free c JOIN {name}_free r
  ON r.pair_id = c.pair_id AND r.key = c.key AND r.k = c.k AND c.side = 1 AND r.side = 0
),
{name}_rest AS (
  SELECT pair_id, side, i, term FROM {before} w WHERE NOT EXISTS (
    SELECT 1 FROM {name}_found f WHERE f.pair_id = w.pair_id AND w.i = CASE w.side WHEN 1 THEN f.c_i ELSE f.r_i END)
)"""


def meteor_sql(synonyms: str | None = None) -> str:
    """CTEs up to ``meteor_scores(pair_id, score)``; ``synonyms`` is an expression of ``term``, the one synset of a word."""
    stages = ["exact", "stem"] + (["synset"] if synonyms else [])
    found = " UNION ALL ".join(f"SELECT * FROM {s}_found" for s in stages)
    return f"""
meteor_lists AS (
  SELECT pair_id, 0 AS side, regexp_extract_all(lower(reference), '[^{WHITE_SPACE}]+') AS words FROM pairs
  UNION ALL SELECT pair_id, 1, regexp_extract_all(lower(candidate), '[^{WHITE_SPACE}]+') FROM pairs
),
meteor_words AS MATERIALIZED (
  SELECT pair_id, side, unnest(words) AS term, unnest(range(1, len(words) + 1)) AS i FROM meteor_lists
),
{stems_sql("meteor_words").replace("stem_step_", "meteor_step_").replace("stems AS", "meteor_stems AS")},
{_stage("exact", "meteor_words", "term")},
{_stage("stem", "exact_rest", "stem", "JOIN meteor_stems USING (term)")},
{_stage("synset", "stem_rest", synonyms) + "," if synonyms else ""}
meteor_found AS (
  SELECT *, c_i = 1 + lag(c_i) OVER places AND r_i = 1 + lag(r_i) OVER places AS joined
  FROM ({found}) WINDOW places AS (PARTITION BY pair_id ORDER BY c_i)
),
meteor_sums AS (
  SELECT pair_id, count(*) AS m, count(*) - count(*) FILTER (joined) AS chunks FROM meteor_found GROUP BY 1
),
meteor_sizes AS (
  SELECT pair_id, count(*) FILTER (side = 0) AS n_r, count(*) FILTER (side = 1) AS n_c FROM meteor_words GROUP BY 1
),
meteor_scores AS (
  SELECT pair_id, coalesce((1 - {GAMMA} * CAST(chunks / m AS DOUBLE) ** {BETA})
    * ((m / n_c) * (m / n_r) / ({ALPHA}::DOUBLE * (m / n_c) + (1 - {ALPHA}::DOUBLE) * (m / n_r))), 0.0) AS score
  FROM pairs LEFT JOIN meteor_sums USING (pair_id) LEFT JOIN meteor_sizes USING (pair_id)
)"""


TEXT_PAIRS_SQL = views.PAIRS_SQL + """,
pairs AS (SELECT dataset_id AS pair_id, original_description AS reference, generated_description AS candidate FROM text_pairs)"""

ROUGE_STEMMED_SQL = (
    "WITH " + TEXT_PAIRS_SQL + "," + STEMMED_TOKENS_SQL + "," + stemmed_rouge_sql(1) + "," + stemmed_rouge_sql(2)
    + """
SELECT pair_id, round(a.score, 6) AS rouge1, round(b.score, 6) AS rouge2
FROM rouge1_scores a JOIN rouge2_scores b USING (pair_id)"""
)

METEOR_SQL = (
    "WITH " + TEXT_PAIRS_SQL + "," + meteor_sql() + " SELECT pair_id, round(score, 6) AS score FROM meteor_scores"
)

# The one synset of a word in the checked run: its first two characters.
SYNSET = "left(term, 2)"

METEOR_SYNONYMS_SQL = (
    "WITH " + TEXT_PAIRS_SQL + "," + meteor_sql(SYNSET) + " SELECT pair_id, round(score, 6) AS score FROM meteor_scores"
)

REPORT_SQL = (
    "WITH RECURSIVE " + views.PAIRS_SQL
    + f""",
pairs AS (
  SELECT dataset_id || '|user' AS pair_id, original_description AS reference, generated_description AS candidate
  FROM text_pairs WHERE regexp_matches(original_description, '[^{WHITE_SPACE}]')
  UNION ALL
  SELECT dataset_id || '|search', original_description, generated_description || chr(10) || title
  FROM text_pairs WHERE regexp_matches(original_description, '[^{WHITE_SPACE}]')
),"""
    + ",".join([STEMMED_TOKENS_SQL, stemmed_rouge_sql(1), stemmed_rouge_sql(2), STEMMED_LCS_SQL, meteor_sql()])
    + """
SELECT metric, split_part(pair_id, '|', 2) AS variant, round(avg(score), 6) AS mean_score, count(*) AS n FROM (
  SELECT 'rouge1' AS metric, * FROM rouge1_scores UNION ALL SELECT 'rouge2', * FROM rouge2_scores
  UNION ALL SELECT 'rougeL', * FROM rougeL_scores UNION ALL SELECT 'meteor', * FROM meteor_scores
) GROUP BY ALL"""
)
