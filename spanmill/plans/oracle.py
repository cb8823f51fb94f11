"""Oracle SQL (DuckDB dialect) for the registered queries.

Each query is a final SELECT over named common table expressions; ``build`` pulls in
the CTEs a query needs in dependency order. The CTEs restate the fixture views and
operators independently of the Spark code (window functions and joins where Spark
uses array expressions), so agreement is a real check.
"""

from __future__ import annotations

import re

WS = r"[\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\p{Z}]"
NOT_WS = r"[^\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\p{Z}]"
SPLIT_RE = rf"([.!?])({WS}+)(\p{{Lu}})"
TOKEN_RE = rf"[\p{{L}}\p{{N}}]+|[^\x{{9}}-\x{{D}}\x{{1C}}-\x{{1F}}\x{{85}}\p{{Z}}\p{{L}}\p{{N}}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + r'+\z')}, '', 'g')"


def rstrip_sql(x: str) -> str:
    return f"regexp_replace({x}, {q(WS + r'+\z')}, '')"


def tokens_sql(x: str) -> str:
    return f"len(regexp_extract_all({x}, {q(TOKEN_RE)}))"


CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


# ---- fixture views -------------------------------------------------------------
cte("udocs", "SELECT * FROM documents WHERE text IS NOT NULL")
cte("sent_rows", f"""
SELECT doc_id, unnest(parts) AS part, unnest(range(0, len(parts))) AS i
FROM (SELECT doc_id, string_split(regexp_replace(text, {q(SPLIT_RE)}, '\\1\\2' || chr(1) || '\\3', 'g'),
                                  chr(1)) AS parts FROM udocs)""")
cte("sentences", f"""
SELECT doc_id, i, start, start + length(text) AS "end", text FROM (
  SELECT doc_id, i,
         CAST(coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
         {rstrip_sql('part')} AS text
  FROM sent_rows)""")
cte("nsent", "SELECT doc_id, count(*) AS n FROM sentences GROUP BY doc_id")
cte("qpairs", """
SELECT u.conv_id, u.turn, u.text AS question, a.text AS reply
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'""")
cte("questions", "SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS k, * FROM qpairs")
cte("pick", """
SELECT s.doc_id, s.start, s.text AS stext, string_split(s.text, ' ') AS w
FROM sentences s JOIN nsent n USING (doc_id) WHERE s.i = s.doc_id % n.n""")
cte("qa", """
SELECT *, start + strpos(stext, answer) - 1 AS answer_start FROM (
  SELECT d.doc_id AS ord, d.doc_id, d.lang, d.source, d.text, q.question,
         CASE WHEN len(p.w) >= 3 THEN p.w[2] || ' ' || p.w[3] ELSE p.stext END AS answer,
         p.start, p.stext
  FROM udocs d JOIN pick p USING (doc_id)
  JOIN questions q ON q.k = d.doc_id % (SELECT count(*) FROM questions))""")
cte("nrank", """
SELECT doc_id, lang, text,
       row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS r,
       count(*) OVER (PARTITION BY lang) AS nl
FROM udocs""")
cte("negs", """
SELECT a.doc_id, list(b.text ORDER BY s.s) AS negs
FROM nrank a CROSS JOIN (VALUES (1), (2), (3)) s(s)
JOIN nrank b ON b.lang = a.lang AND b.r = (a.r + s.s) % a.nl
GROUP BY a.doc_id""")
cte("spans", """
SELECT question, text AS context, answer, answer_start, ord FROM qa WHERE doc_id % 5 <> 0
UNION ALL
SELECT question, text AS context, answer, -1 AS answer_start, -1 - ord AS ord
FROM qa WHERE doc_id % 5 <> 0 AND doc_id % 7 = 0""")


def deps(body: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", body)]


def build(final: str, extra: dict[str, str] | None = None) -> str:
    """WITH <needed CTEs in dependency order> <final>."""
    table = dict(CTES)
    if extra:
        table.update(extra)
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order:
            return
        body = table[name]
        for d in [n for n in table if n != name and re.search(rf"\b{n}\b", body)]:
            if d not in stack:
                visit(d, stack + (name,))
        order.append(name)

    for n in [n for n in table if re.search(rf"\b{n}\b", final)]:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({table[n]})" for n in order) + "\n" + final
