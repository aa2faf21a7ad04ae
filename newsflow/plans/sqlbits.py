"""DuckDB SQL fragments mirroring the column functions (for oracle SQL only)."""

from __future__ import annotations

from newsflow.functions.text import WHITE_SPACE

# HTML entities that the test pages hold.
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE) + ")"


def go_trim(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def has_text(x: str) -> str:
    return f"coalesce(length({go_trim(x)}) > 0, FALSE)"


def effective_title(title: str = "title", translated: str = "translated_title") -> str:
    return go_trim(f"coalesce({translated}, {title})")


def unescape(x: str) -> str:
    out = x
    for ent, ch in HTML_ENTITIES:
        out = f"replace({out}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return out


def html_title(x: str) -> str:
    return go_trim(unescape(f"regexp_extract({x}, '(?is)<title[^>]*>(.*?)</title>', 1)"))


def norm(x: str) -> str:
    inner = f"trim(regexp_replace(lower({x}), '[^\\p{{L}}]+', ' ', 'g'))"
    return f"(CASE WHEN length({inner}) > 0 THEN ' ' || {inner} || ' ' END)"


def trigram_rows(source: str, keys: str, text: str) -> str:
    """Rows (keys..., trigram) of every text of ``source`` (overlapping, whole text)."""
    return (f"SELECT {keys}, unnest(list_transform(range(1, len(c) - 1), "
            f"lambda i: c[i] || c[i + 1] || c[i + 2])) AS trigram "
            f"FROM (SELECT {keys}, string_split({norm(text)}, '') AS c FROM {source})")


def profiles_cte(top: int = 300) -> str:
    """Language profiles fitted from the documents table (lang, trigram, rank)."""
    return f"""SELECT lang, trigram, rank FROM (
  SELECT lang, trigram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, trigram) AS rank
  FROM (SELECT lang, trigram, count(*) AS n
        FROM ({trigram_rows('(SELECT * FROM documents WHERE lang IS NOT NULL)', 'lang', 'text')})
        GROUP BY lang, trigram)) WHERE rank <= {top}"""


def detect_cte(source: str, id_col: str, text: str, top: int = 300, profiles: str = "profiles") -> str:
    """(id, detected) for the rows of ``source`` (NULL rows absent)."""
    return f"""SELECT _id AS {id_col}, first(lang ORDER BY score DESC, lang) AS detected FROM (
  SELECT d._id, p.lang, sum({top} - abs(d.rank - p.rank)) AS score
  FROM (SELECT _id, trigram, rank FROM (
          SELECT _id, trigram, row_number() OVER (PARTITION BY _id ORDER BY n DESC, trigram) AS rank
          FROM (SELECT _id, trigram, count(*) AS n
                FROM ({trigram_rows(f"(SELECT {id_col} AS _id, {text} AS _t FROM {source})", "_id", "_t")})
                GROUP BY _id, trigram)) WHERE rank <= {top}) d
  JOIN {profiles} p USING (trigram)
  GROUP BY d._id, p.lang) GROUP BY _id"""


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: length(t) > 0)"
