"""Pieces of DuckDB SQL that the queries' SQL is put together from."""

from __future__ import annotations

# White space as Unicode has it; RE2's \s is ASCII's.
WS = r"[\x09-\x0d \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, {q(flags)})"


def strip(x: str) -> str:
    return rx(x, f"^{WS}+|{WS}+$")


def clean_text(x: str) -> str:
    c = rx(rx(f"coalesce({x}, '')", "\r\n?", "\n"), "[ \t]+", " ")
    return strip(rx(c, "\n{3,}", "\n\n"))


def clean_line(x: str) -> str:
    return strip(rx(f"coalesce({x}, '')", f"{WS}+", " "))


def match_key(x: str) -> str:
    folded = f"lower(strip_accents(translate(coalesce({x}, ''), 'Đđ', 'Dd')))"
    return strip(rx(rx(folded, r"[^a-z0-9 \t\n\x0B\f\r]", " "), r"[ \t\n\x0B\f\r]+", " "))


def edge_key(x: str) -> str:
    return rx(f"lower({clean_line(x)})", r"\p{Nd}+", "#")


def lines(table: str, keys: str, text: str, where: str = "true") -> str:
    """A subquery: keys, line_no, line of every line of every text."""
    return f"(SELECT {keys}, unnest(range(1, len(_l) + 1)) AS line_no, unnest(_l) AS line FROM (SELECT {keys}, string_split(replace(replace({text}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS _l FROM {table} WHERE {text} IS NOT NULL AND {where}))"


def any_start(x: str, values: list[str]) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {q(v)})" for v in values) + ")"


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def upper_ratio(x: str) -> str:
    letters = f"length(regexp_replace({x}, '\\P{{L}}', '', 'g'))"
    return f"(CASE WHEN {letters} = 0 THEN 0.0 ELSE length(regexp_replace({x}, '\\P{{Lu}}', '', 'g'))::DOUBLE / {letters} END)"


def marker_cte(table: str, keys: str, text: str) -> str:
    """CTEs up to ``m``: keys, line_no, c (cleaned line), kind, mark, content, key (of the line), ckey (of the content)."""
    number, roman, letter = rf"^(\p{{Nd}}+\.\p{{Nd}}+(?:\.\p{{Nd}}+)*\.?|\p{{Nd}}+[.)]){WS}+(.+)$", rf"^([IVXLCDMivxlcdm]+)[.)]{WS}+(.+)$", rf"^([a-zA-ZđĐ])[.)/]{WS}+(.+)$"
    pick = lambda g: f"CASE kind WHEN 'number' THEN regexp_extract(c, {q(number)}, {g}) WHEN 'roman' THEN regexp_extract(c, {q(roman)}, {g}) WHEN 'letter' THEN regexp_extract(c, {q(letter)}, {g}) ELSE {q('') if g == 1 else 'c'} END"
    return f"""
    l AS (SELECT {keys}, line_no, {clean_line('line')} AS c FROM {lines(table, keys, text)}),
    k AS (SELECT *, CASE WHEN {matches('c', number)} THEN 'number' WHEN {matches('c', roman)} THEN 'roman' WHEN {matches('c', letter)} THEN 'letter' END AS kind FROM l),
    s AS (SELECT *, {pick(1)} AS mark, {strip(pick(2))} AS content FROM k),
    m AS (SELECT *, {match_key('c')} AS key, {match_key('content')} AS ckey FROM s)
    """


def heading_cte() -> str:
    """CTE ``h`` over ``m``: adds the heading predicates and ``level``."""
    from foliant.functions import lines as P

    strong = f"({any_start('ckey', P.HEADINGS)} OR (length(content) <= 130 AND {upper_ratio('content')} >= 0.65))"
    contents = lambda x: matches(x, rf"\.{{4,}}|{WS}\.{{2,}}{WS}*\p{{Nd}}+{WS}*$")
    says = f"(content <> '' AND NOT {contents('content')} AND NOT (length(content) > 120 AND {matches('content', '[.;,]$')}) AND ({strong} OR (length(content) <= 90 AND ends_with(content, ':'))))"
    depth = "length(regexp_replace(regexp_replace(mark, '[.)]+$', ''), '[^.]', '', 'g'))"
    after = strip("regexp_extract(content, '(?s)^[^:]*:(.*)$', 1)")
    explained = f"(contains(content, ':') AND {after} <> '' AND len(regexp_split_to_array({after}, {q(WS + '+')})) >= 3)"
    return f"""
    h AS (SELECT *,
        {matches('c', rf"^(Điều|ĐIỀU|Dieu|DIEU){WS}+\p{{Nd}}+")} AS is_article,
        {matches('c', rf"^(Chương|CHƯƠNG|Chuong|CHUONG){WS}+([IVXLCDM]+|\p{{Nd}}+)")} AS is_chapter,
        {matches('c', rf"^(Mục|MỤC|Muc|MUC){WS}+\p{{Nd}}+")} AS is_section,
        (key IN ({', '.join(map(q, P.TITLES))}) OR ({any_start('key', P.FORM_TITLES)} AND length(key) <= 120)) AS is_title,
        {contents('c')} AS is_contents,
        (c <> '' AND NOT {contents('c')} AND {matches('ckey', '^(quy trinh|luu do)' + chr(92) + 'b')}) AS is_process,
        CASE WHEN kind IS NOT NULL AND {says} THEN
            CASE WHEN kind = 'roman' THEN 2
                 WHEN kind = 'number' AND {depth} = 0 THEN CASE WHEN {strong} THEN 2 END
                 WHEN kind = 'number' AND {depth} = 1 THEN 3
                 WHEN kind = 'number' THEN 4
                 WHEN NOT {explained} THEN 4 END
        END AS level
        FROM m),
    f AS (SELECT *, (c = '' OR {any_start('c', ['<!--', '#', *P.APART])} OR {matches('c', r'[.]{6,}|_{4,}|[[] []]')} OR is_article OR is_chapter OR is_section OR is_title OR is_process OR level IS NOT NULL) AS is_structural FROM h)
    """


MARKDOWN = """CASE WHEN starts_with(c, '<!--') THEN c WHEN is_title THEN '# ' || c WHEN is_process THEN '## ' || c WHEN level IS NOT NULL THEN repeat('#', level) || ' ' || c
    WHEN is_chapter THEN '## ' || c WHEN is_section OR is_article THEN '### ' || c ELSE c END"""
