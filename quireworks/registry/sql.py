"""Pieces of the check SQL (DuckDB dialect) that several queries share."""

WS = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NON_PRINTABLE = r"[\x00-\x1f\x7f-\x9f\p{Cf}\p{Co}\p{Zl}\p{Zp}]"

# Space separators but the plain space.
NO_BREAK_SPACES = r"[\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def clean(x: str) -> str:
    spaced = collapse(f"replace(coalesce({x}, ''), chr(0), '')")
    return f"trim(regexp_replace({spaced}, '{NON_PRINTABLE}', '', 'g'), ' ')"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


# Documents as pages: the source is the title, the document its page.
PAGES = "SELECT source AS title, doc_id AS page_no, text AS content FROM documents"

# Documents as files: each line of a document is one page of the file.
FILE_PAGES = """
    SELECT 's3://library/' || source || '/' || doc_id || '.pdf' AS source,
           doc_id || '.pdf' AS title,
           unnest(range(len(string_split(text, chr(10))))) AS page_no,
           unnest(string_split(text, chr(10))) AS content
    FROM documents"""

# Text with some letters exchanged for NUL, zero-width space, no-break space and line separator.
NOISY = "translate(text, 'zkwq', chr(0) || chr(8203) || chr(160) || chr(8232))"


def chunks(pages: str, name: str = "chunks") -> str:
    """CTEs ending in ``name`` (title, page_no, chunk_idx, content, content_hash): the
    recursive rule over the relation ``pages`` (title, page_no, content), as offsets.

    Pieces under 1000 characters form runs, by sentence or inside a longer sentence by
    word; a recursive walk over the cut points of each run gives its spans. A word of
    1000 or more characters is cut into windows.
    """
    p = name
    return f"""
    {p}_text AS (
        SELECT title, page_no, {clean("content")} AS content FROM ({pages})
    ), {p}_split AS (
        SELECT title, page_no, content, string_split(content, '. ') AS a
        FROM {p}_text WHERE content <> ''
    ), {p}_sentence AS (
        SELECT *, length(piece) >= 1000 AS long FROM (
            SELECT title, page_no, i, CASE WHEN i = 1 THEN a[i] ELSE '. ' || a[i] END AS piece
            FROM (SELECT title, page_no, a, unnest(range(1, len(a) + 1)) AS i FROM {p}_split)
        ) WHERE piece <> ''
    ), {p}_word AS (
        SELECT *, length(piece) >= 1000 AS long FROM (
            SELECT title, page_no, i, j, CASE WHEN j = 1 THEN a[j] ELSE ' ' || a[j] END AS piece
            FROM (SELECT title, page_no, i, a, unnest(range(1, len(a) + 1)) AS j
                  FROM (SELECT *, string_split(piece, ' ') AS a FROM {p}_sentence WHERE long))
        ) WHERE piece <> ''
    ), {p}_piece AS (
        SELECT title, page_no, 0 AS i, i AS j, piece, long,
               sum(long::INT) OVER (PARTITION BY title, page_no ORDER BY i) AS run
        FROM {p}_sentence
        UNION ALL
        SELECT title, page_no, i, j, piece, long,
               sum(long::INT) OVER (PARTITION BY title, page_no, i ORDER BY j)
        FROM {p}_word
    ), {p}_end AS (
        SELECT *, sum(length(piece)) OVER (PARTITION BY title, page_no, i, run ORDER BY j) AS hi
        FROM {p}_piece WHERE NOT long
    ), {p}_run AS (
        SELECT title, page_no, i, run, min(j) AS first, string_agg(piece, '' ORDER BY j) AS body,
               list_prepend(0, list(hi::BIGINT ORDER BY j)) AS cuts, max(hi)::BIGINT AS total
        FROM {p}_end GROUP BY title, page_no, i, run
    ), {p}_span AS (
        SELECT title, page_no, i, run, 0::BIGINT AS lo,
               list_max(list_filter(cuts, lambda x: x <= 1000)) AS hi
        FROM {p}_run
        UNION ALL
        SELECT title, page_no, i, run, lo,
               list_max(list_filter(cuts, lambda x: x <= lo + 1000)) AS hi
        FROM (
            SELECT title, page_no, i, run, cuts,
                   list_min(list_filter(cuts, lambda x: x >= greatest(hi - 200, after - 1000))) AS lo
            FROM (
                SELECT r.title, r.page_no, r.i, r.run, r.cuts, s.hi,
                       list_min(list_filter(r.cuts, lambda x: x > s.hi)) AS after
                FROM {p}_span s JOIN {p}_run r
                  ON r.title = s.title AND r.page_no = s.page_no AND r.i = s.i AND r.run = s.run
                WHERE s.hi < r.total
            )
        )
    ), {p}_cut AS (
        SELECT s.title, s.page_no, CASE WHEN s.i = 0 THEN r.first ELSE s.i END AS k1,
               CASE WHEN s.i = 0 THEN 0 ELSE r.first END AS k2, s.lo AS k3,
               trim(substring(r.body, s.lo + 1, s.hi - s.lo), ' ') AS content
        FROM {p}_span s JOIN {p}_run r
          ON r.title = s.title AND r.page_no = s.page_no AND r.i = s.i AND r.run = s.run
        UNION ALL
        SELECT title, page_no, i, j, w, trim(substring(piece, 800 * w + 1, 1000), ' ')
        FROM (SELECT *, unnest(range(greatest(ceil((length(piece) - 200) / 800), 1)::BIGINT)) AS w
              FROM {p}_word WHERE long)
    ), {p} AS (
        SELECT title, page_no,
               row_number() OVER (PARTITION BY title, page_no ORDER BY k1, k2, k3) - 1 AS chunk_idx,
               {clean("content")} AS content, sha256({clean("content")}) AS content_hash
        FROM {p}_cut WHERE content <> ''
    )"""
