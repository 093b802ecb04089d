"""Personal data: pattern spans, and terms that give them away.

Base spans are e-mail addresses, IP addresses, payment cards and phone
numbers: leftmost, non-overlapping matches per kind, dropped if they fail
their check. The patterns are written so that Java's matcher needs neither
recursion nor repeated scans of a long run, with the same matches: classes
that can't reach past their delimiter are possessive, and a match can only
start where a run starts or the last match ended.

Sanitisation is information-theoretic. A protected entity is a base value, a
term any whole word of the text that no base span touches. With N texts, n_e
texts holding entity e, n_t texts holding term t and n_et texts holding both,
the information that t gives about e is

    PMI(e; t) = log(N * n_et / (n_e * n_t))        at most  IC(e) = log(N / n_e)

and t discloses e if PMI / IC >= ``threshold`` with n_et >= ``support``.
Copies of one text are one piece of evidence (every count is of distinct
texts). A term that discloses an entity does so wherever it stands: each of
its occurrences, in any text, with the entity or without, becomes a span of
kind ``term``; :func:`sanitise` generalises every span to its kind.

Everything is DataFrame functions. Distinct texts are reduced to their base
spans and distinct words once; words are counted map-side before the shuffle.
Only terms and entities that the two bounds leave possible meet, text by text.

Edge cases: null text is empty; spans depend on the text alone, so repeated
rows and null ids get the same spans as any row with that text; overlapping
spans of different kinds are all listed, and one replacement covers their
union; a corpus in which every text holds the entity (IC = 0) discloses
nothing; an empty table gives an empty result; input columns that clash with
helper columns are kept by :func:`sanitise` and ignored by :func:`spans`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root, shared_path

# The pattern of each kind, in output order, and a cheap test that a text may hold it.
PATTERNS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "instr({t}, '@') > 0"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"rlike({t}, r'[0-9]\.[0-9]')"),
    "card": (r"[0-9](?:[ -]?[0-9])++", r"rlike({t}, r'[0-9][ -]?[0-9]')"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", r"rlike({t}, r'[+][0-9]')"),
}
KINDS = [*PATTERNS, "term"]
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_DIGITS = "regexp_replace({v}, '[^0-9]', '')"
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + CASE WHEN i % 2 = 1 THEN int(substr({d}, -i, 1)) "
    "ELSE element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), int(substr({d}, -i, 1)) + 1) END) % 10 = 0")
CHECKS = {
    "email": "true",
    "ip": rf"rlike({{v}}, r'^{_OCTET}[.]{_OCTET}[.]{_OCTET}[.]{_OCTET}$')",
    "card": f"CASE WHEN length({_DIGITS}) BETWEEN 16 AND 19 THEN {_LUHN.format(d=_DIGITS)} ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
}
_WORD = r"[\p{L}\p{N}]+"
_MARK = "5d1fc0a7e9b24863"                                   # letters and digits, so that it is part of the word beside it
_NO_SPANS = "CAST(array() AS array<struct<kind: string, start: int, end: int, value: string>>)"


def _literal(pattern: str) -> str:
    return "r'" + pattern + "'"


def _let(value: str, name: str, expr: str) -> str:
    """``expr`` with ``name`` standing for a value that is computed once, as SQL."""
    return f"element_at(transform(array({value}), {name} -> {expr}), 1)"


#: Spans are put together in parts of so many: appending to an array copies it.
_PART = 64


def _parts(array: str) -> str:
    """The array (a name) cut into parts, as SQL."""
    return (f"if(size({array}) > 0, transform(sequence(0, (size({array}) - 1) DIV {_PART}), b -> slice({array}, b * {_PART} + 1, {_PART})), "
            f"slice(array({array}), 1, 0))")


def _placed(pieces: str, matches: str, kind: str, base: str = "0") -> str:
    """Spans of the matches between the pieces that a split left, as SQL.

    Each part is placed from where the matches of the parts before it end.
    """
    sized = f"transform({matches}, (m, i) -> struct(length(element_at({pieces}, i + 1)) AS gap, length(m) AS own, m AS value))"
    begins = (f"aggregate(ps, struct(int({base}) AS at, CAST(array() AS array<int>) AS got), (s, p) -> struct("
              "int(s.at + aggregate(p, 0, (n, x) -> int(n + x.gap + x.own))) AS at, concat(s.got, array(s.at)) AS got), s -> s.got)")
    part = (f"aggregate(z.ps, struct(z.begins AS at, {_NO_SPANS} AS got), (s, x) -> struct(int(s.at + x.gap + x.own) AS at, "
            f"concat(s.got, array(struct('{kind}' AS kind, int(s.at + x.gap) AS start, int(s.at + x.gap + x.own) AS end, x.value AS value))) AS got), s -> s.got)")
    placed = f"flatten(transform(arrays_zip(ps, begins), z -> {part}))"
    return _let(sized, "xs", _let(_parts("xs"), "ps", _let(begins, "begins", placed)))


def _with_base(docs: DataFrame, text: str, to: str) -> DataFrame:
    """Add ``to``: the checked base spans of the text column, by kind, then start."""
    for kind, (pattern, may) in PATTERNS.items():
        p = _literal(pattern)
        docs = docs.withColumn(f"_m_{kind}", F.expr(
            f"CASE WHEN {may.format(t=text)} THEN regexp_extract_all({text}, {p}, 0) ELSE CAST(array() AS array<string>) END"))
        docs = docs.withColumn(f"_p_{kind}", F.expr(
            f"CASE WHEN size(_m_{kind}) > 0 THEN split({text}, {p}, -1) ELSE CAST(array() AS array<string>) END"))
    each = [f"CASE WHEN size(_m_{k}) > 0 THEN filter({_placed(f'_p_{k}', f'_m_{k}', k)}, x -> {CHECKS[k].format(v='x.value')}) "
            f"ELSE {_NO_SPANS} END" for k in PATTERNS]
    return docs.withColumn(to, F.expr(f"concat({', '.join(each)})")).drop(
        *(f"_m_{k}" for k in PATTERNS), *(f"_p_{k}" for k in PATTERNS))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _key(text: str) -> Column:
    """Names the text; rows of empty text have no spans and a key of their own."""
    return F.expr(f"CASE WHEN {text} = '' THEN concat('#', xxhash64(doc_id)) ELSE sha2({text}, 256) END")


_NO_CUT = "CAST(array() AS array<struct<start: int, end: int, kind: string>>)"


def _union(column: str) -> str:
    """The union of overlapping spans, each named after its first, as SQL.

    The sorted spans' parts are united each, then joined: of a later part
    only the spans that begin before the last end can belong to it.
    """
    one = (f"aggregate(p, {_NO_CUT}, (a, x) -> CASE "
           "WHEN size(a) > 0 AND x.start < element_at(a, -1).end THEN concat(slice(a, 1, size(a) - 1), array(struct("
           "element_at(a, -1).start AS start, greatest(element_at(a, -1).end, x.end) AS end, element_at(a, -1).kind AS kind))) "
           "ELSE concat(a, array(x)) END)")
    more = ("CASE WHEN size(a) = 0 OR size(u) = 0 OR element_at(u, 1).start >= element_at(a, -1).end THEN concat(a, u) ELSE concat("
            "slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start AS start, greatest(element_at(a, -1).end, "
            "array_max(transform(filter(u, y -> y.start < element_at(a, -1).end), y -> y.end))) AS end, element_at(a, -1).kind AS kind)), "
            "filter(u, y -> y.start >= element_at(a, -1).end)) END")
    whole = f"aggregate(transform({_parts('ss')}, p -> {one}), {_NO_CUT}, (a, u) -> {more})"
    return _let(f"array_sort(transform({column}, x -> struct(x.start AS start, x.end AS end, x.kind AS kind)))", "ss", whole)


def _cut_out(text: str, cut: str, by: str) -> str:
    """The text with each span x of a union replaced, as SQL.

    ``by`` may use ``piece``, the text from ``z.at`` on: it is cut into
    pieces of some spans first, since finding a place takes as long as the
    text before it.
    """
    begins = "transform(ps, (p, j) -> CASE WHEN j = 0 THEN 0 ELSE element_at(element_at(ps, j), -1).end END)"
    before = "CASE WHEN i = 0 THEN z.at ELSE element_at(z.ps, i).end END"
    part = (f"concat(array_join(transform(z.ps, (x, i) -> concat(substring(piece, {before} - z.at + 1, x.start - {before}), {by})), ''))")
    part = _let(f"substring({text}, z.at + 1, element_at(z.ps, -1).end - z.at)", "piece", part)
    parts = _let(cut, "cs", _let(_parts("cs"), "ps", _let(begins, "at", f"array_join(transform(arrays_zip(ps, at), z -> {part}), '')")))
    return f"concat({parts}, substring({text}, element_at({cut}, -1).end + 1))"


#: What a table may take to be broadcast.
BROADCAST_BYTES = 16 << 20


def _few(table: DataFrame, size: str) -> DataFrame:
    """Broadcast if the table, of rows of so many bytes (SQL), is small; else joined as Spark sees fit, with the same result."""
    return F.broadcast(table) if (table.agg(F.sum(F.expr(f"32L + {size}"))).first()[0] or 0) <= BROADCAST_BYTES else table


_TERM_BYTES = "aggregate(terms, 0L, (n, x) -> n + 48 + octet_length(x.value))"


def texts(docs: DataFrame) -> DataFrame:
    """(key, base, words) of every distinct text, written once.

    ``words`` are the distinct whole words that no base span touches, as
    spelled. Where a span's edge is inside a word, the mark joins what is left
    of the word and takes it along.
    """
    rows = docs.select(_text().alias("text")).withColumn("key", F.sha2("text", 256)).dropDuplicates(["key"])
    rows = _with_base(rows, "text", "base").withColumn("cut", F.expr(_union("base")))
    first, last = (f"CASE WHEN rlike(substring(piece, {at} - z.at, 1), r'{_WORD}') THEN '{_MARK}' ELSE '' END" for at in ("x.start + 1", "x.end"))
    by = f"{first}, ' ', {last}"
    rest = f"CASE WHEN size(cut) > 0 THEN {_cut_out('text', 'cut', by)} ELSE text END"
    rows = rows.withColumn("rest", F.expr(rest)).select("key", "base", F.expr(
        f"filter(array_distinct(regexp_extract_all(rest, r'{_WORD}', 0)), w -> instr(w, '{_MARK}') = 0)").alias("words"))
    path = shared_path(docs.sparkSession, "pii", unique=True)
    rows.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def disclosing(known: DataFrame, threshold: float, support: int) -> DataFrame:
    """(entity, term) pairs whose PMI reaches the threshold's share of the entity's information."""
    n = known.count()
    terms = known.select("key", F.explode(F.array_distinct(F.transform("words", F.lower))).alias("term"))
    holds = known.where("size(base) > 0").select("key", F.explode(F.expr(
        "array_distinct(transform(base, x -> concat(x.kind, ':', lower(x.value))))")).alias("entity"))
    # a pair of n_et texts needs as many of each side, and PMI / IC >= threshold is n_t <= n_et * (N / n_e) ** (1 - threshold)
    entities = holds.groupBy(F.col("entity").alias("e")).agg(F.count("*").alias("n_e")).where(
        (F.col("n_e") >= support) & (F.col("n_e") < n)).withColumn("most", F.col("n_e") * F.pow(F.lit(n) / F.col("n_e"), F.lit(1 - threshold)) * 1.000001)
    holds = holds.join(entities, F.col("entity") == F.col("e")).drop("e").checkpoint()
    most = holds.agg(F.max("most")).first()[0]
    if most is None:
        return holds.select("entity", F.col("key").alias("term")).limit(0)
    often = terms.groupBy(F.col("term").alias("t")).agg(F.count("*").alias("n_t")).where(F.col("n_t").between(support, most))
    # only the words of texts with a base span travel to that join
    near = known.where("size(base) > 0").select("key", F.explode(F.array_distinct(F.transform("words", F.lower))).alias("term")).join(
        holds.select("key").distinct(), "key", "left_semi").join(often, F.col("term") == F.col("t")).drop("t")
    pairs = near.join(holds, "key").where("n_t <= most").groupBy("entity", "term", "n_e", "n_t").agg(F.count("*").alias("n_et"))
    gain = F.log(n * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    return pairs.where((F.col("n_et") >= support) & (gain >= threshold * F.log(n / F.col("n_e")))).select("entity", "term")


def _marked(docs: DataFrame, threshold: float = 0.9, support: int = 2) -> tuple[DataFrame, DataFrame]:
    """(key, base) of every distinct text, and (of, terms) of those with a disclosing term."""
    checkpoint_root(docs.sparkSession)
    known = texts(docs)
    terms = disclosing(known, threshold, support).select(F.col("term").alias("t")).distinct().checkpoint()
    hits = known.select("key", F.explode("words").alias("word")).join(_few(terms, "octet_length(t)"), F.lower("word") == F.col("t")).groupBy(
        F.col("key").alias("k")).agg(F.collect_set("word").alias("hit")).checkpoint()
    rows = docs.select(_text().alias("text")).withColumn("of", F.sha2("text", 256)).join(
        _few(hits, "aggregate(hit, 0L, (n, x) -> n + 24 + octet_length(x))"), F.col("of") == F.col("k")).drop("k").dropDuplicates(["of"])
    rows = rows.join(known.where("size(base) > 0").select("key", "base"), F.col("of") == F.col("key"), "left")
    # longer spellings can't be cut short: what follows a match is no letter
    pattern = r"concat(r'(?<![\p{L}\p{N}])(?:', array_join(hit, '|'), r')(?![\p{L}\p{N}])')"
    rows = rows.withColumn("pattern", F.expr(pattern)).withColumn("_m", F.expr("regexp_extract_all(text, pattern, 0)")).withColumn(
        "_p", F.expr("split(text, pattern, -1)"))
    rows = rows.select("of", F.expr(
        f"transform(filter({_placed('_p', '_m', 'term')}, t -> NOT exists(coalesce(base, {_NO_SPANS}), x -> x.start < t.end AND x.end > t.start)), "
        "t -> struct(t.kind AS kind, t.start AS start, t.end AS end, lower(t.value) AS value))").alias("terms"))
    return known.select("key", "base"), rows.checkpoint()


def spans(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, key, base and all (arrays of kind, start, end, value; all has the terms last)."""
    known, terms = _marked(docs, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text")).select("doc_id", _key("text").alias("key"))
    based = known.where("size(base) > 0").select(F.col("key").alias("b"), "base")
    rows = rows.join(based, F.col("key") == F.col("b"), "left").join(_few(terms, _TERM_BYTES), F.col("key") == F.col("of"), "left")
    return rows.withColumn("base", F.expr(f"coalesce(base, {_NO_SPANS})")).select(
        "doc_id", "key", "base", F.expr(f"concat(base, coalesce(terms, {_NO_SPANS}))").alias("all"))


def _listed(column: str) -> str:
    return f"array_join(transform({column}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, a count for each base kind, base_sha256, spans, n_term."""
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = '{k}')) AS long)").alias(f"n_{k}") for k in PATTERNS]
    return spans(docs, **options).select(
        "doc_id", *counts, F.expr(f"sha2({_listed('base')}, 256)").alias("base_sha256"), F.expr(_listed("all")).alias("spans"),
        F.expr("CAST(size(all) - size(base) AS long)").alias("n_term"))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """The input rows with every span generalised to its kind, e.g. ``[EMAIL]``.

    Rows that may hold a base span are shuffled to their spans; the others
    only if the terms found in such texts are too many to broadcast.
    ``n_chars`` follows the new text.
    """
    known, terms = _marked(docs, **options)
    marked = known.join(terms, F.col("key") == F.col("of"), "left").select(
        F.col("key").alias("of"), F.expr(f"concat(base, coalesce(terms, {_NO_SPANS}))").alias("all")).where("size(all) > 0")
    # the patterns' own tests are cheap; a row that passes none can't have a base span
    may = F.expr(" OR ".join(f"({m.format(t="coalesce(CAST(text AS string), '')")})" for _, m in PATTERNS.values()))
    keyed = [_key("coalesce(CAST(text AS string), '')").alias("key"), F.struct(*docs.columns).alias("row")]
    hit = docs.where(may).select(*keyed).join(marked, F.col("key") == F.col("of"), "left").unionByName(
        docs.where(~may).select(*keyed).join(_few(terms, _TERM_BYTES).withColumnRenamed("terms", "all"), F.col("key") == F.col("of"), "left"))
    clean = _cut_out("row.text", "cut", "'[', upper(x.kind), ']'")
    hit = hit.withColumn("cut", F.expr(_union("all"))).withColumn("clean", F.expr(f"CASE WHEN size(cut) > 0 THEN {clean} END"))
    new = {"text": F.coalesce("clean", "row.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.char_length("clean").cast(docs.schema["n_chars"].dataType), F.col("row.n_chars"))
    return hit.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
