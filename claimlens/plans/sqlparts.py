"""Reusable DuckDB SQL fragments for the oracle queries.

These restate each derived view in plain SQL, independently of the Spark
plans, so that the oracle checks the Spark result rather than re-running it.
"""

from __future__ import annotations

from claimlens.constants import EXPANSION_STOPWORDS, LABELS, SEED
from claimlens.functions.text import stopwords

LABEL_LIST = "[" + ", ".join(f"'{x}'" for x in LABELS) + "]"
LABEL_ORDER = "CASE {c} WHEN 'false' THEN 1 WHEN 'mixed' THEN 2 WHEN 'true' THEN 3 ELSE 4 END"
TOKEN_RE = r"[\p{L}\p{N}_]{2,}"


def h(tag: str, key: str = "doc_id", pos: int = 1) -> str:
    """Integer of 8 hex digits of md5('tag:' || key) from ``pos``."""
    return f"('0x' || substr(md5('{tag}:' || CAST({key} AS VARCHAR)), {pos}, 8))::BIGINT"


def decode(idx: str) -> str:
    return f"{LABEL_LIST}[({idx}) + 1]"


def r6(x: str) -> str:
    return f"(floor(({x}) * 1000000.0E0 + 0.5E0) / 1000000.0E0)"


def fixed(x: str, d: int) -> str:
    scale = 10 ** d
    units = f"CAST(floor(({x}) * {float(scale)!r}E0 + 0.5E0) AS BIGINT)"
    return (f"(CAST(CAST(floor({units} / {scale}) AS BIGINT) AS VARCHAR) || '.' || "
            f"lpad(CAST({units} % {scale} AS VARCHAR), {d}, '0'))")


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOPWORDS_SQL = sql_list(stopwords())
EXPANSION_STOPWORDS_SQL = sql_list(EXPANSION_STOPWORDS)

LABELED = """labeled AS (
  SELECT doc_id, d.text,
         CASE WHEN l.toxic = 1 THEN 'mixed' WHEN l.quality = 1 THEN 'true' ELSE 'false' END AS label
  FROM documents d JOIN labels l USING (doc_id))"""


def split_ctes(src: str, out: str, test_size: float = 0.2, seed: int = SEED, salt: str = "split",
               names=("train", "test"), key: str = "doc_id") -> str:
    """Largest-remainder stratified split of ``src`` into CTE ``out`` (adds ``split``)."""
    p = f"{out}_"
    return f"""{p}c AS (SELECT label, count(*) AS n_class FROM {src} GROUP BY label),
{p}a AS (SELECT label, n_class, sum(n_class) OVER () AS n FROM {p}c),
{p}b AS (SELECT *, CAST(n - ceil({test_size!r}E0 * n) AS BIGINT) AS n_train_total FROM {p}a),
{p}d AS (SELECT *, CAST(n_class * n_train_total AS DOUBLE) / n AS cont FROM {p}b),
{p}e AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM {p}d),
{p}f AS (SELECT *, n_train_total - sum(fl) OVER () AS need,
                row_number() OVER (ORDER BY rem DESC, {LABEL_ORDER.format(c='label')}, label) AS rk FROM {p}e),
{p}q AS (SELECT label, n_class - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS n_test FROM {p}f),
{p}r AS (SELECT s.*, row_number() OVER (PARTITION BY label ORDER BY {h(f'{seed}:{salt}', key)}, {key}) AS _ord
         FROM {src} s),
{out} AS (SELECT r.* EXCLUDE (_ord), CASE WHEN r._ord <= q.n_test THEN '{names[1]}' ELSE '{names[0]}' END AS split
          FROM {p}r r JOIN {p}q q USING (label))"""


SPLIT = split_ctes("labeled", "split")

CLAIMS = r"""claims AS (
  SELECT doc_id, text, label, text AS headline FROM split WHERE split = 'test'),
evidence AS (SELECT doc_id, text, label FROM split WHERE split = 'train')"""

PREDS = f"""preds AS (
  SELECT doc_id, label AS gold,
         {decode(h('p') + ' % 3')} AS base_label,
         CASE WHEN {h('p', pos=9)} % 10 = 0 THEN NULL ELSE ({h('p', pos=17)} % 10000) / 10000.0E0 END
           AS base_confidence,
         CASE WHEN {h('e')} % 13 = 0 THEN NULL ELSE {decode(h('e', pos=9) + ' % 3')} END AS evidence_label,
         CASE WHEN {h('e')} % 13 = 0 THEN NULL ELSE (9000 + {h('e', pos=17)} % 1001) / 10000.0E0 END
           AS evidence_confidence
  FROM labeled)"""

MERGE_RULE = """CASE WHEN {el} IS NULL THEN 1
     WHEN {el} = {bl} THEN 2
     WHEN {bc} IS NULL AND {ec} >= 0.95E0 THEN 3
     WHEN {bc} IS NULL THEN 7
     WHEN {bc} < 0.50E0 AND {ec} >= 0.95E0 THEN 4
     WHEN {bc} < 0.60E0 AND {el} = 'mixed' AND {ec} >= 0.95E0 THEN 5
     ELSE 6 END"""


def merge_rule(bl="base_label", bc="base_confidence", el="evidence_label", ec="evidence_confidence") -> str:
    return MERGE_RULE.format(bl=bl, bc=bc, el=el, ec=ec)


def final_label(bl="base_label", bc="base_confidence", el="evidence_label", ec="evidence_confidence") -> str:
    rule = merge_rule(bl, bc, el, ec)
    return f"CASE WHEN ({rule}) IN (3, 4) THEN {el} WHEN ({rule}) = 5 THEN 'mixed' ELSE {bl} END"


def fine_source() -> str:
    pick = f"({h('f')} % 2)"
    idx = (f"CASE WHEN label = 'true' THEN CASE WHEN {pick} = 0 THEN 3 ELSE 2 END "
           f"WHEN label = 'mixed' THEN CASE WHEN {pick} = 0 THEN 1 ELSE 4 END "
           f"ELSE CASE WHEN {pick} = 0 THEN 0 ELSE 5 END END")
    fine_names = "['false', 'half-true', 'mostly-true', 'true', 'barely-true', 'pants-fire']"
    return f"""fine0 AS (SELECT doc_id, text, CAST({idx} AS INTEGER) AS fine_label_id,
                     CASE WHEN {h('s')} % 10 < 8 THEN 'train' WHEN {h('s')} % 10 = 8 THEN 'validation'
                          ELSE 'test' END AS split FROM labeled),
fine_src AS (SELECT doc_id, text, fine_label_id,
       CASE {fine_names}[fine_label_id + 1]
         WHEN 'true' THEN 'true' WHEN 'mostly-true' THEN 'true' WHEN 'half-true' THEN 'mixed'
         WHEN 'barely-true' THEN 'mixed' WHEN 'false' THEN 'false' WHEN 'pants-fire' THEN 'false' END AS label,
       'documents' AS source, split FROM fine0),
bin_src AS (SELECT item_id AS doc_id, text,
       CASE CASE WHEN {h('b', 'item_id')} % 2 = 0 THEN 'real' ELSE 'fake' END
         WHEN 'real' THEN 'true' WHEN 'fake' THEN 'false' END AS label,
       'benchmark' AS source, CAST(NULL AS VARCHAR) AS split FROM benchmark),
corpus AS (SELECT doc_id, text, label, source, split FROM fine_src
           UNION ALL SELECT doc_id, text, label, source, split FROM bin_src)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
