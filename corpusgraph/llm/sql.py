"""SQL texts that give the rows of the queries they are named for, over the given tables."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _windows(source: str, key: str, size: int) -> str:
    """Rows (key, i, k, gram): each ``size`` words in a row, from place i on."""
    frame = f"OVER (PARTITION BY {key} ORDER BY i ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)"
    return (
        f"SELECT * FROM (SELECT {key}, i, {size} AS k, string_agg(word, ' ') {frame} AS gram, "
        f"count(*) {frame} AS held FROM {source}) WHERE held = {size}"
    )


def _decontamination(size: int = 13) -> str:
    short = " UNION ALL ".join(
        f"({_windows(f'(SELECT * FROM item WHERE n = {k})', 'item_id', k)})" for k in range(1, size)
    )
    of_documents = " UNION ALL ".join(f"({_windows('doc', 'doc_id', k)})" for k in range(1, size + 1))
    return f"""
WITH doc_words AS (SELECT doc_id, coalesce({_ITEM_WORDS}, []) AS words FROM documents),
doc AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM doc_words),
item_words AS (SELECT item_id, coalesce({_ITEM_WORDS}, []) AS words FROM benchmark),
item AS (SELECT item_id, len(words) AS n, unnest(words) AS word, unnest(range(len(words))) AS i FROM item_words),
item_grams AS (
  SELECT DISTINCT item_id, k, gram FROM (
    ({_windows(f'(SELECT * FROM item WHERE n >= {size})', 'item_id', size)}) UNION ALL {short})),
hits AS (SELECT d.doc_id, d.i, d.k, g.item_id FROM ({of_documents}) d JOIN item_grams g USING (k, gram)),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS place FROM hits),
hit_words AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def _substring_dedup(size: int = 13) -> str:
    return rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
doc AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM doc_words),
grams AS ({_windows('doc', 'doc_id', size)}),
firsts AS (SELECT gram, min(doc_id) AS first_id FROM grams GROUP BY gram),
starts AS (SELECT doc_id, i FROM grams JOIN firsts USING (gram) WHERE doc_id > first_id),
marked AS (
  SELECT doc.doc_id, doc.i, word,
    count(starts.i) OVER (PARTITION BY doc.doc_id ORDER BY doc.i ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW) > 0
      AS gone
  FROM doc LEFT JOIN starts ON doc.doc_id = starts.doc_id AND doc.i = starts.i),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS left_over
  FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(left_over, '')) AS kept_sha256
FROM doc_words LEFT JOIN kept USING (doc_id)"""


_NIBBLES = "".join(f"{k:04b}" for k in range(16))
_BITS = (
    f"array_to_string([substr('{_NIBBLES}', 4 * instr('0123456789abcdef', substr(digest, p, 1)) - 3, 4) "
    "FOR p IN range(1, 41)], '')"
)
_FIVE = " + ".join(f"{16 >> k} * CAST(substr(bits, 5 * p + {k + 1}, 1) AS INT)" for k in range(5))
_WARC = f"""
WITH payload AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS digest, min(page_id) OVER (PARTITION BY body) AS first_id
  FROM payload),
coded AS (SELECT *, {_BITS} AS bits FROM digests)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + {_FIVE} AS INT), 1) FOR p IN range(32)], '')
    AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM coded"""

SQL: dict[str, str] = {
    "op4_decontamination": _decontamination(),
    "op9_substring_dedup": _substring_dedup(),
    "op10_warc": _WARC,
}
