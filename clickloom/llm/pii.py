"""Information-theoretic sanitisation, with DataFrame operations only.

Base patterns find the protected entities. The words of a document that holds an entity, but for those that
overlap a base span, are its terms; over the corpus, a term's disclosure of an entity is their pointwise mutual
information, log2(n(e,t) * N / (n(e) * n(t))), as a share of the entity's own information, log2(N / n(e)), with n
counted in documents. Terms that occur with the entity in `support` documents or more and disclose at least
`disclosure` of it are generalised (capitalised ones) or removed like the entity itself, wherever they stand in
a document that holds it.

Whole texts are scanned, in code points; all counts are over all rows, each of which is a document. A null text counts as
empty. Rows with the same id and text have the same spans; an empty table gives an empty result; of
the input only doc_id and text are read, so other columns can't clash.

Patterns that a regular expression could retry along a run are anchored to the run's start, and
repetitions are possessive, so that time is linear in the text; the matches are those of the plain
patterns. Entities that stand in the same documents are counted as one, and a term that is too
frequent to disclose an entity even if it were in all its documents isn't paired with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled

KINDS = ("email", "ip", "card", "phone", "term")
MARK, OTHER = "\u0001", "\u0002"
_LOCAL = r"[A-Za-z0-9._%+-]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without one of these has no match; cheaper to look for.
NEEDS = {"email": ("@",), "ip": (".",), "card": (), "phone": ("+",)}
TERM = r"\p{L}{3,}+"
SPAN = "struct<kind:string,start:int,end:int,value:string>"
BLOCK = 64


@dataclass(frozen=True)
class Sanitise:
    """disclosure: least share of an entity's information; support: least documents."""

    disclosure: float = 0.8
    support: int = 2


def _spans(text: str, pattern: str, kind: str, valid: str, needs: str = "true") -> str:
    """SQL for the array of spans of `pattern` in the column `text`, which holds no MARK.

    Matches are wrapped in marks and the text is split at them, so that every second part is a
    match; positions are running sums of lengths, in blocks, so that many matches stay linear.
    """
    marked = f"split(regexp_replace({text}, r'{pattern}', '{MARK}$0{MARK}'), '{MARK}')"
    offsets = f"""
      transform(array(transform(parts, p -> length(p))), n ->
        transform(array(sequence(0, (size(n) - 1) div {BLOCK})), bs ->
          transform(array(aggregate(bs, array(0), (o, b) -> concat(o, array(element_at(o, -1) + aggregate(slice(n, b * {BLOCK} + 1, {BLOCK}), 0, (a, x) -> a + x))))), os ->
            flatten(transform(bs, b -> slice(aggregate(slice(n, b * {BLOCK} + 1, {BLOCK}), array(os[b]), (o, x) -> concat(o, array(element_at(o, -1) + x))), 1, {BLOCK}))))[0])[0])[0]"""
    found = f"""transform(array({marked}), parts -> case when size(parts) = 1 then cast(array() as array<{SPAN}>) else
      transform(array({offsets}), at -> filter(transform(parts, (p, i) -> named_struct('kind', case when i % 2 = 1 then '{kind}' end, 'start', at[i], 'end', at[i] + length(p), 'value', p)), s -> s.kind is not null and {valid}))[0] end)[0]"""
    return f"case when {needs} then {found} else cast(array() as array<{SPAN}>) end"


_DIGITS = "regexp_replace(s.value, '[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": rf"s.value rlike r'^{_PART}(?:\.{_PART}){{3}}$'",
    "card": f"""aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a + transform(array(cast(substr({_DIGITS}, length({_DIGITS}) + 1 - i, 1) as int)),
        x -> case when i % 2 = 1 then x when x > 4 then 2 * x - 9 else 2 * x end)[0]) % 10 = 0""",
    "phone": f"length({_DIGITS}) between 8 and 15",
}


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), t (the text without MARK) and base, the spans by kind and then start."""
    t = F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(OTHER))
    kinds = [k for k in KINDS if k != "term"]
    needs = {k: " and ".join([f"contains(t, '{x}')" for x in NEEDS[k]] + (["t rlike '[0-9]'"] if k != "email" else [])) for k in kinds}
    per_kind = [F.expr(_spans("t", PATTERNS[k], k, VALID[k], needs[k])) for k in kinds]
    return docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), t.alias("t")).withColumn("base", F.concat(*per_kind))


def _entity(span: str) -> str:
    return f"concat({span}.kind, ':', case when {span}.kind in ('card', 'phone') then regexp_replace({span}.value, '[^0-9]', '') else lower({span}.value) end)"


#: The words of `t` that overlap no base span.
_TERMS = f"filter({_spans('t', TERM, 'term', 'true')}, x -> not exists(base, s -> s.start < x.end and x.start < s.end))"


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, n_term): in how many documents each word of letters is; summed up in each task before the shuffle."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    return docs.where("text is not null").select(F.explode(words).alias("term")).where("length(term) >= 3").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))


def _held(texts: DataFrame, n: int, how: Sanitise) -> DataFrame:
    """(row, class, n_entity): a class is the entities of the same documents; those below the support can't be disclosed.

    Each row is a document, as in all counts, even where it repeats an id and a text.
    """
    held = texts.select("row", F.explode(F.array_distinct(F.expr(f"transform(base, b -> {_entity('b')})"))).alias("entity"))
    two = [F.bit_xor(F.xxhash64(F.lit(salt), "row")).cast("string") for salt in (1, 2)]
    count = F.count(F.lit(1))
    classes = held.groupBy("entity").agg(count.alias("n_entity"), F.concat_ws(":", count.cast("string"), *two).alias("class"))
    usable = classes.where((F.col("n_entity") >= how.support) & (F.col("n_entity") < n))
    return held.join(usable, "entity").select("row", "class", "n_entity").distinct()


def disclosing(held: DataFrame, words: DataFrame, counts: DataFrame, n: int, how: Sanitise) -> DataFrame:
    """(class, term) whose disclosure reaches the threshold.

    held: (row, class, n_entity); words: (row, term), once each; counts: of the terms in the corpus; n: documents.
    """
    known = words.join(counts.where(F.col("n_term") >= how.support), "term")
    most = n * F.pow(F.col("n_entity") / n, F.lit(how.disclosure)) * (1 + 1e-9)  # n_both is n_entity at most
    pairs = known.join(held, "row").where(F.col("n_term") <= most).groupBy("class", "n_entity", "term", "n_term").agg(F.count(F.lit(1)).alias("n_both"))
    shared = F.log2(F.col("n_both") * n / (F.col("n_entity") * F.col("n_term")))
    return pairs.where((F.col("n_both") >= how.support) & (shared / F.log2(n / F.col("n_entity")) >= how.disclosure)).select("class", "term")


def find(docs: DataFrame, how: Sanitise = Sanitise()) -> DataFrame:
    """doc_id, digest, base, terms: the base spans and the terms (start, end) that disclose an entity of the document."""
    base = settled(base_spans(docs).withColumn("t", F.when(F.size("base") > 0, F.col("t"))).withColumn("row", F.monotonically_increasing_id()))
    n, texts = base.count(), base.where("size(base) > 0")
    held = settled(_held(texts, n, how))
    spans = texts.join(held.select("row").distinct(), "row", "left_semi").select("row", "doc_id", "digest", F.explode(F.expr(_TERMS)).alias("x"))
    found = spans.select("row", "doc_id", "digest", F.lower("x.value").alias("term"), "x.start", "x.end")
    hit = disclosing(held, found.select("row", "term").distinct(), term_counts(docs), n, how)
    marks = held.join(hit, "class").select("row", "term").distinct()
    terms = found.join(marks, ["row", "term"]).groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("terms"))
    b, t = base.alias("b"), terms.alias("t")
    joined = b.join(t, F.col("b.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("b.digest") == F.col("t.digest")), "left")
    return joined.select("b.doc_id", "b.digest", "b.base", F.expr("coalesce(t.terms, cast(array() as array<struct<start:int,end:int>>))").alias("terms"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term from `find`'s rows."""
    text = "concat(s.kind, ':', s.start, ':', s.end)"
    base = F.expr(f"concat_ws(',', transform(base, s -> {text}))")
    every = F.expr(f"concat_ws(',', concat(transform(base, s -> {text}), transform(terms, s -> concat('term:', s.start, ':', s.end))))")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS if k != "term"]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"), F.size("terms").cast("long").alias("n_term"))


def sanitise(docs: DataFrame, how: Sanitise = Sanitise()) -> DataFrame:
    """`docs` with every base span generalised to its kind, and disclosing terms to <name> or removed."""
    spans = find(docs, how).dropDuplicates(["doc_id", "digest"]).withColumnsRenamed({"doc_id": "sid", "digest": "sdigest"})
    d = docs.select(F.struct("*").alias("d"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    joined = d.join(spans, F.col("d.doc_id").eqNullSafe(F.col("sid")) & (F.col("digest") == F.col("sdigest")), "left")
    ordered = """array_sort(concat(transform(base, x -> struct(x.start as start, x.end as end, concat('<', x.kind, '>') as mark)),
        transform(terms, x -> struct(x.start as start, x.end as end,
          case when substring(d.text, x.start + 1, 1) rlike '\\\\p{Lu}' then '<name>' else '' end as mark))))"""
    clean = f"""case when d.text is null then null else aggregate({ordered}, struct('' as out, 0 as at),
        (a, x) -> case when x.start < a.at then struct(a.out as out, greatest(a.at, x.end) as at)
          else struct(concat(a.out, substring(d.text, a.at + 1, x.start - a.at), x.mark) as out, x.end as at) end,
        a -> concat(a.out, substring(d.text, a.at + 1))) end"""
    return joined.select(*(F.expr(clean).alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
