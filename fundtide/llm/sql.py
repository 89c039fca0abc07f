"""SQL twins of the operators that SQL can express."""

from __future__ import annotations

from fundtide.llm import merkle

#: The CRC table, from its polynomial.
CRC_TABLE = """crc_step AS (SELECT i, i::UBIGINT AS c, 0 AS k FROM range(256) t(i)),
crc_rows AS (
  WITH RECURSIVE turned(i, c, k) AS (
    SELECT i, c, k FROM crc_step
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM turned WHERE k < 8)
  SELECT i, c FROM turned WHERE k = 8),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM crc_rows)"""


def crc32_sql(codes: str) -> str:
    """SQL for the unsigned crc32 of a list of byte values; ``tab`` must be in scope."""
    step = "xor(c >> 8, tab[(xor(c, b) & 255)::INT + 1])"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {codes}), lambda c, b: {step}), 4294967295::UBIGINT)"


def _merkle_sql(depth: int, fanout: int) -> str:
    """The manifest in SQL, for groups of up to fanout ** depth rows."""
    field = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')".format
    fields = lambda text: " || ".join(field(c) for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text))
    lower = f"translate(text, '{merkle._UPPER}', '{merkle._LOWER}')"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)"
    parts = [CRC_TABLE, f"""leaf AS (
  SELECT doc_id, lang, sha256({fields('text')}) AS leaf,
    CASE WHEN {crc32_sql(digits)} % 3 = 0 THEN sha256({fields(lower)}) END AS bad
  FROM documents, crc_table),
l0 AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaf),
g0 AS (SELECT lang AS g, pos AS idx, n, leaf AS d FROM l0)"""]

    def climb(name: str) -> None:
        for k in range(depth):
            parts.append(f"""{name}r{k} AS (
  SELECT g, idx // {fanout} AS run, any_value(n) AS n, list(d ORDER BY idx) AS ds FROM {name}{k} WHERE n > 1 GROUP BY 1, 2),
{name}{k + 1} AS (SELECT g, run AS idx, (n + {fanout - 1}) // {fanout} AS n, sha256(array_to_string(ds, '')) AS d FROM {name}r{k})""")
        tops = " UNION ALL ".join(f"SELECT g, d FROM {name}{k} WHERE n = 1" for k in range(depth + 1))
        parts.append(f"{name}top AS ({tops})")

    def prove(source: str, name: str, position: str, group: str) -> str:
        """Steps up from the rows of ``source``: proof text and folded digest."""
        for k in range(depth):
            parts.append(f"""{source}{name}{k} AS (
  SELECT s.* EXCLUDE (proof, folded),
    CASE WHEN r.ds IS NULL THEN proof ELSE proof || array_to_string(list_concat(r.ds[:slot], r.ds[slot + 2:]), '') END AS proof,
    CASE WHEN r.ds IS NULL THEN folded ELSE sha256(array_to_string(r.ds[:slot], '') || folded || array_to_string(r.ds[slot + 2:], '')) END AS folded
  FROM (SELECT *, ({position} // {fanout ** k}) % {fanout} AS slot FROM {source}{f'{name}{k - 1}' if k else ''}) s
  LEFT JOIN {name}r{k} r ON r.g IS NOT DISTINCT FROM s.{group} AND r.run = s.{position} // {fanout ** (k + 1)})""")
            parts[-1] = parts[-1].replace("SELECT s.* EXCLUDE (proof, folded)", "SELECT s.* EXCLUDE (proof, folded, slot)")
        return f"{source}{name}{depth - 1}"

    climb("g")
    parts.append("""h0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, d, g AS member FROM gtop)""")
    climb("h")
    parts.append("""p AS (
  SELECT l0.doc_id, l0.lang, l0.leaf, l0.pos, h0.idx AS place, 0 AS one, h0.d AS subroot, '' AS proof, coalesce(l0.bad, l0.leaf) AS folded
  FROM l0 JOIN h0 ON h0.member IS NOT DISTINCT FROM l0.lang)""")
    proved = prove("p", "g", "pos", "lang")
    proved = prove(proved, "h", "place", "one")
    return f"""WITH {', '.join(parts)}
SELECT doc_id, leaf, subroot, htop.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = htop.d AS verified
FROM {proved}, htop"""


MERKLE_SQL = _merkle_sql(8, merkle.FANOUT)


#: UTF-8 bytes of a text of code points below 2048.
_BYTES = """flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::UBIGINT]
      ELSE [(192 + (unicode(x) >> 6))::UBIGINT, (128 + (unicode(x) & 63))::UBIGINT] END))"""

VARIANTS_SQL = f"""WITH {CRC_TABLE},
run AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), '{merkle._UPPER}', '{merkle._LOWER}') AS run
  FROM documents),
counted AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS mark, run, count(*) AS n FROM run GROUP BY 1, 2),
hashed AS (SELECT run, n, {crc32_sql(_BYTES.format('mark'))} AS h FROM counted, crc_table),
spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed),
word AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b
  FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM word)),
less AS (SELECT DISTINCT c.word AS long_word, w.word AS short_word FROM cut c JOIN word w ON w.word = c.a || c.b),
near AS (
  SELECT long_word AS word, short_word AS other FROM less UNION ALL SELECT short_word, long_word FROM less
  UNION ALL SELECT c.word, d.word FROM cut c JOIN cut d ON c.i = d.i AND c.a = d.a AND c.b = d.b AND c.word <> d.word),
best AS (
  SELECT near.word, count(*) AS n_near, arg_max(near.other, (o.n, -o.place)) AS other, max(o.n) AS other_n
  FROM near JOIN (SELECT *, row_number() OVER (ORDER BY word) AS place FROM word) o ON o.word = near.other GROUP BY 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
    CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM word w LEFT JOIN best b ON b.word = w.word),
chain AS (
  WITH RECURSIVE up(word, root, form) AS (
    SELECT word, word, form FROM formed
    UNION ALL
    SELECT up.word, up.form, f.form FROM up JOIN formed f ON f.word = up.form)
  SELECT word, root FROM up WHERE form IS NULL)
SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain ON chain.word = f.word"""
