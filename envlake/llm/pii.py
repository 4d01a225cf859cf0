"""Personal data by expressions only: regular expressions propose spans,
checksum validators confirm them and nearby context words adjust a score.

Nothing leaves the JVM and nothing is shuffled: each row is worked on alone.
Offsets come from cutting the text at the matches (``split``) and adding up the
lengths of the pieces and of the matches (``regexp_extract_all``).

The patterns find what the plain definitions find, leftmost and without
overlap, but in linear time: possessive quantifiers, and look-behinds that let
a match start only where a run of its characters starts or where the last match
ended (``\\G``), so a run of 100,000 digits is walked once, not once a digit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points on either side of a span in which context words count.
WINDOW = 40


@dataclass(frozen=True)
class Kind:
    """``check`` is SQL over ``m`` (the match); scores are in percent."""

    name: str
    pattern: str
    check: str
    score: int
    words: str
    bonus: int = 10
    needs: str = ""


_MAIL = "[A-Za-z0-9._%+-]"
KINDS = (
    # email: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", 90,
         "mail|contact|write to|reach", needs="@"),
    # ip: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         "forall(split(m, '[.]'), p -> length(trim(LEADING '0' FROM p)) <= 3 "
         "and coalesce(try_cast(p as decimal(38)), 0) <= 255)", 60,
         "ip|host|server|address|login", 20, needs="."),
    # card: [0-9]([ -]?[0-9])+ is a whole chain of digits; those of 12 to 19 that pass Luhn
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
         "aggregate(split(reverse(regexp_replace(m, '[ -]', '')), ''), named_struct('i', 0, 's', 0), "
         "(a, c) -> named_struct('i', a.i + 1, 's', a.s + case when a.i % 2 = 0 then coalesce(try_cast(c as int), 0) "
         "when c > '4' then 2 * coalesce(try_cast(c as int), 0) - 9 "
         "else 2 * coalesce(try_cast(c as int), 0) end), a -> a.s % 10 = 0)", 75,
         "card|visa|credit|payment|account", 20),
    # phone: \+[0-9][ ().0-9-]+[0-9], 9 to 15 digits
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "length(regexp_replace(m, '[^0-9]', '')) between 9 and 15", 60,
         "phone|call|tel|mobile|fax", 30, needs="+"),
    # iban: country, check digits, account; the number's remainder by 97 is 1
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+",
         "aggregate(split(concat(substring(m, 5), substring(m, 1, 4)), ''), 0, (a, c) -> "
         "case when c between '0' and '9' then (a * 10 + coalesce(try_cast(c as int), 0)) % 97 "
         "when c = '' then a else (a * 100 + ascii(c) - 55) % 97 end) = 1", 85,
         "iban|bank|account|transfer", 15),
)
BASE = ("email", "ip", "card", "phone")


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def _spans(kind: Kind, order: int) -> Column:
    """array<struct<start, ord, kind, end, score>> of one kind over ``__t``."""
    p = _sql(kind.pattern)
    found = f"""aggregate(
        zip_with(slice(split(__t, {p}, -1), 1, size(regexp_extract_all(__t, {p}, 0))),
                 regexp_extract_all(__t, {p}, 0), (seg, m) -> named_struct('gap', length(seg), 'm', m)),
        named_struct('at', 0, 'out', cast(array() as array<struct<start:int,m:string>>)),
        (a, x) -> named_struct('at', a.at + x.gap + length(x.m),
                               'out', concat(a.out, array(named_struct('start', a.at + x.gap, 'm', x.m)))),
        a -> a.out)"""
    near = (f"lower(substring(__t, greatest(x.start - {WINDOW}, 0) + 1, "
            f"length(x.m) + x.start - greatest(x.start - {WINDOW}, 0) + {WINDOW}))")
    checked = f"filter({found}, x -> exists(array(x.m), m -> {kind.check}))"
    made = f"""transform({checked}, x -> named_struct('start', x.start, 'ord', {order}, 'kind', '{kind.name}',
        'end', x.start + length(x.m),
        'score', {kind.score} + if({near} rlike '{kind.words}', {kind.bonus}, 0)))"""
    any_here = f"contains(__t, '{kind.needs}')" if kind.needs else "__t rlike '[0-9]'"
    none = "cast(array() as array<struct<start:int,ord:int,kind:string,end:int,score:int>>)"
    return F.expr(f"if({any_here}, {made}, {none})")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, pii`` for every row: its spans, an array of ``start, ord, kind,
    end, score`` sorted by start and kind (code points, end exclusive).

    A null or empty text has no spans. Null and repeated ids and repeated rows
    keep one result row each; other columns are ignored; an empty table gives an
    empty result.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t"))
    parts = [_spans(k, i) for i, k in enumerate(KINDS)]
    return src.select(F.col("__id").alias(id_col), F.array_sort(F.concat(*parts)).alias("pii"))


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans and scores as text."""
    kinds = ", ".join(f"'{k}'" for k in BASE)
    line = "concat_ws(':', s.kind, s.start, s.end)"
    counts = [F.expr(f"cast(size(filter(pii, s -> s.kind = '{k.name}')) as bigint)").alias(f"n_{k.name}") for k in KINDS]
    return find_pii(docs, id_col, text_col).select(
        F.col(f"`{id_col}`"), *counts,
        F.expr(f"sha2(array_join(transform(filter(pii, s -> s.kind in ({kinds})), s -> {line}), ','), 256)").alias("base_sha256"),
        F.expr(f"array_join(transform(pii, s -> {line}), ',')").alias("spans"),
        F.expr("array_join(transform(pii, s -> concat_ws(':', s.kind, s.start, s.score)), ',')").alias("scores"))


def _oracle_kind(name: str, order: int, pattern: str, check: str, score: int, words: str, bonus: int) -> str:
    return f"""SELECT doc_id, t, '{name}' AS kind, {order} AS ord, {score} AS score, {bonus} AS bonus, '{words}' AS words,
      UNNEST(list_zip(
        list_transform(range(1, len(regexp_extract_all(t, '{pattern}')) + 1), lambda i:
          coalesce(list_sum(list_transform(regexp_split_to_array(t, '{pattern}')[1:i], lambda s: length(s))), 0)
          + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:i - 1], lambda s: length(s))), 0)),
        regexp_extract_all(t, '{pattern}'))) AS hit
    FROM d"""


def _oracle() -> str:
    luhn = """list_sum(list_transform(range(1, length(g) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse(g)[i] AS INT)
        ELSE (2 * CAST(reverse(g)[i] AS INT)) // 10 + (2 * CAST(reverse(g)[i] AS INT)) % 10 END)) % 10 = 0"""
    spell = "list_transform(string_split(concat(m[5:], m[1:4]), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END)"
    digits = f"string_split(array_to_string({spell}, ''), '')"
    mod97 = f"list_reduce(list_prepend(0, list_transform({digits}, lambda c: CAST(c AS INT))), lambda a, c: (a * 10 + c) % 97) = 1"
    hits = " UNION ALL ".join([
        _oracle_kind("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "", 90, "mail|contact|write to|reach", 10),
        _oracle_kind("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "", 60, "ip|host|server|address|login", 20),
        _oracle_kind("card", 2, r"[0-9]([\x20-]?[0-9])+", "", 75, "card|visa|credit|payment|account", 20),
        _oracle_kind("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", "", 60, "phone|call|tel|mobile|fax", 30),
        _oracle_kind("iban", 4, "[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", "", 85, "iban|bank|account|transfer", 15)])
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    hits AS ({hits}),
    flat AS (SELECT doc_id, t, kind, ord, score, bonus, words, hit[1] AS s, hit[2] AS m,
        regexp_replace(hit[2], '[^0-9]', '', 'g') AS g FROM hits),
    good AS (SELECT *, s + length(m) AS e,
        score + CASE WHEN regexp_matches(lower(t[greatest(s - 40, 0) + 1 : s + length(m) + 40]), words) THEN bonus ELSE 0 END AS points
      FROM flat WHERE CASE kind
        WHEN 'ip' THEN list_max(list_transform(string_split(m, '.'), lambda p: CAST(p AS DOUBLE))) <= 255
        WHEN 'card' THEN length(g) BETWEEN 12 AND 19 AND {luhn}
        WHEN 'phone' THEN length(g) BETWEEN 9 AND 15
        WHEN 'iban' THEN {mod97}
        ELSE true END),
    per AS (SELECT doc_id,
        {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in (*BASE, 'iban'))},
        string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, ord) FILTER (kind <> 'iban') AS base,
        string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, ord) AS spans,
        string_agg(concat(kind, ':', s, ':', points), ',' ORDER BY s, ord) AS scores
      FROM good GROUP BY doc_id)
    SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in (*BASE, 'iban'))},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
    FROM d LEFT JOIN per USING (doc_id)"""


ORACLE = _oracle()
