"""Secrets in texts by a trigram inverted index.

DataFrame and SQL functions only. The index holds postings (trigram, text) of
every trigram of every text, whatever the rules. Each rule's regex gives a
Boolean query over the trigrams that any match must contain; intersecting
their postings leaves candidates, on which the regex itself is run. A rule
without mandatory trigrams scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import unused, written


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``min_chars`` or more."""
    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1


# Fixed values. The hex rule asks for the 24 characters in the pattern: a
# shorter run has no match and a longer one matches whole, as with [0-9a-f]+.
BASE_RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, min_chars=6),
    Rule("access", r"AKIA[A-Z0-9]+", min_chars=20),
    Rule("hex", r"[0-9a-f]{24,}", min_chars=24),
]
MORE_RULES = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[0-9a-zA-Z]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z]{3,10}://[A-Za-z0-9._%+-]{1,40}:[A-Za-z0-9._%+-]{3,60}@"),
]
RULES = BASE_RULES + MORE_RULES


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def trigram_query(pattern: str, widest: int = 64) -> list[frozenset[str]]:
    """Alternatives, each a set of trigrams that must all occur in the
    lower-cased text for ``pattern`` to match. An empty set among them says
    that some match needs no trigram: then every text is a candidate.
    """
    anything = [frozenset()]

    def both(a, b):
        if len(a) * len(b) > widest:        # keep the one that asks for more
            return max(a, b, key=lambda q: min(map(len, q)))
        return list({x | y for x, y in product(a, b)})

    def exact(items) -> set[str] | None:
        """The finite set of strings that a piece can match, if small."""
        found = {""}
        for op, arg in items:
            if op is sre.LITERAL:
                part = {chr(arg).lower()}
            elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
                part = {chr(a).lower() for _, a in arg}
            elif op is sre.SUBPATTERN:
                part = exact(arg[3])
            elif op is sre.BRANCH:
                parts = [exact(x) for x in arg[1]]
                part = None if None in parts else set().union(*parts)
            elif op is sre.MAX_REPEAT and arg[0] == 0 and arg[1] == 1:
                part = exact(arg[2])
                part = part and part | {""}
            elif op is sre.MAX_REPEAT and arg[0] == arg[1] and arg[0] <= 8:
                part = exact(list(arg[2]) * arg[0])
            else:
                part = None
            if part is None or len(found) * len(part) > widest:
                return None
            found = {a + b for a in found for b in part}
        return found

    def query(items):
        out, run = anything, {""}

        def close():
            nonlocal out, run
            out, run = both(out, list({_trigrams(s) for s in run})), {""}

        for item in items:
            op, arg = item
            part = exact([item])
            if part is not None and len(run) * len(part) <= widest:
                run = {a + b for a in run for b in part}
                continue
            close()
            if part is not None:
                run = part
            elif op is sre.SUBPATTERN:
                out = both(out, query(arg[3]))
            elif op is sre.BRANCH:
                sub = [q for x in arg[1] for q in query(x)]
                out = both(out, sub if len(sub) <= widest else anything)
            elif op is sre.MAX_REPEAT and arg[0] >= 1:
                out = both(out, query(arg[2]))
        close()
        return out

    found = set(query(sre_parser.parse(pattern)))
    if frozenset() in found:
        return anything
    # a set that contains another one asks for nothing new
    return sorted((q for q in found if not any(o < q for o in found)), key=sorted)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and text_hash, which tells rows of one doc_id apart."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))


#: A text is read in pieces of this many characters, each with the two that
#: follow, so that the trigrams held at once don't grow with the text.
PIECE_CHARS = 4096


def build_index(docs: DataFrame) -> DataFrame:
    """Postings (trigram, text_hash) of all trigrams of the lower-cased texts,
    written ordered by trigram within each file.

    ``trigram`` is the XXH64 of the three characters and ``text_hash`` that of
    the text (null as empty): equal numbers of different texts or trigrams can
    only add candidates. A text longer than a piece may repeat a posting.
    """
    piece = F.regexp_extract_all(F.lower("text"), F.lit(f"(?s)(?=(.{{1,{PIECE_CHARS + 2}}})).{{1,{PIECE_CHARS}}}"),
                                 F.lit(1))
    three = F.array_distinct(F.regexp_extract_all("piece", F.lit("(?s)(?=(...))."), F.lit(1)))
    return written(_keyed(docs).select("text_hash", F.explode(piece).alias("piece"))
                   .select("text_hash", F.explode(three).alias("three"))
                   .select(F.xxhash64("three").alias("trigram"), "text_hash")
                   .sortWithinPartitions("trigram"), "trigram-index")


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """kind, text_hash: texts that hold all trigrams of one of the kind's
    alternatives. Of the index only pages that hold asked trigrams are read."""
    spark = index.sparkSession
    terms = [(kind, i, t, len(q)) for kind, alternatives in queries.items()
             for i, q in enumerate(alternatives) for t in sorted(q)]
    asked = (spark.createDataFrame(terms, "kind string, alternative int, three string, needed int")
             .withColumn("trigram", F.xxhash64("three")))
    # lists of up to ten values are pushed into the scan as they are
    values = sorted({t for _, _, t, _ in terms})
    held = F.lit(False)
    for i in range(0, len(values), 10):
        held = held | F.col("trigram").isin([F.xxhash64(F.lit(t)) for t in values[i:i + 10]])
    # a row for each trigram of each rule: bounded by the rules
    return (index.filter(held).distinct().join(F.broadcast(asked), "trigram")
            .groupBy("kind", "alternative", "needed", "text_hash").agg(F.count("*").alias("n"))
            .filter(F.col("n") == F.col("needed")).select("kind", "text_hash").distinct())


def _matches(rows: DataFrame, rule: Rule) -> DataFrame:
    """One row per match of ``rule`` that passes: its span in code points.

    The text is cut at the matches: pieces and matches alternate, and the sum
    of the lengths before a match is where it starts.
    """
    whole = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    sizes = lambda c: F.transform(c, lambda x: F.length(x))
    cut = (rows.select("doc_id", "text_hash", sizes(F.split("text", rule.pattern)).alias("before"),
                       sizes(whole).alias("size"), sizes(part).alias("part"))
           .filter(F.size("size") > 0))
    return (cut.select("doc_id", "text_hash", F.posexplode(F.arrays_zip("before", "size", "part")).alias("nth", "m"))
            .select(F.lit(rule.kind).alias("kind"), "doc_id", "text_hash", "nth", "m.before", "m.size",
                    (F.col("m.part") >= rule.min_chars).alias("passes"))
            .filter("size is not null"))


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, index: DataFrame | None = None) -> DataFrame:
    """kind, doc_id, text_hash, start, end: the secrets of every text.

    ``index`` is ``build_index`` of these texts, or of more, made before; it
    serves any rules. Without it one is built.

    Per rule the matches are leftmost and don't overlap; those that are too
    short are dropped. ``start`` and ``end`` (exclusive) are code points.
    Repeated rows give their spans once (the same doc_id and text); null
    texts are empty; an empty table gives no rows.
    """
    keyed = _keyed(docs)
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    scan_fully = {k for k, q in queries.items() if frozenset() in q}
    asked = {k: q for k, q in queries.items() if k not in scan_fully}
    found: list[DataFrame] = []
    if asked:
        hits = candidates(build_index(docs) if index is None else index, asked)
        # few texts are candidates: they are read once for all rules
        at = written(hits.groupBy("text_hash").agg(F.collect_set("kind").alias("kinds")), "secret-candidates")
        texts = written(keyed.join(at, "text_hash").select("doc_id", "text_hash", "text", "kinds"), "secret-texts")
        found += [_matches(texts.filter(F.array_contains("kinds", r.kind)), r) for r in rules if r.kind in asked]
    found += [_matches(keyed.filter(F.col("text").rlike(r.pattern)), r) for r in rules if r.kind in scan_fully]
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    every = written(every, "secret-matches").distinct()
    # a window holds the matches of one kind in one text
    up_to = "over (partition by kind, doc_id, text_hash order by nth)"
    return (every.withColumn("end", F.expr(f"sum(before + size) {up_to}").cast("bigint"))
            .filter("passes")
            .select("kind", "doc_id", "text_hash", (F.col("end") - F.col("size")).alias("start"), "end"))


def _digest(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_report(docs: DataFrame, rules: list[Rule] = RULES, base: list[Rule] = BASE_RULES) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds (n_<kind>), the
    SHA-256 of the base spans, and all spans as kind:start:end by start, then
    kind in the order of ``rules``. Texts without secrets, empty and null ones
    among them, have zeros and empty lists; columns beside doc_id and text
    aren't read.
    """
    rank = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)))
    spans = find_secrets(docs, rules).withColumn("rank", rank[F.col("kind")])
    of = (spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(
        F.struct("start", "rank", "end", "kind"))).alias("all"))
        .select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "all"))
    of = written(of, "secret-spans")
    rows = _keyed(docs).select("doc_id", "text_hash")
    joined = rows.join(of, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    every = F.coalesce("all", F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>"))
    kinds = F.array(*(F.lit(r.kind) for r in base))
    def of_kind(kind):
        return F.size(F.filter(every, lambda x: x["kind"] == kind)).cast("bigint")

    counts = [of_kind(r.kind).alias(f"n_{r.kind}") for r in base]
    base_spans = F.filter(every, lambda x: F.array_contains(kinds, x["kind"]))
    return joined.select("doc_id", *counts, F.sha2(_digest(base_spans).cast("binary"), 256).alias("base_sha256"),
                         _digest(every).alias("spans"), "text_hash")


def redact(docs: DataFrame, rules: list[Rule] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask`` (overlapping
    spans by one); all rows and columns stay, ``n_chars`` follows the text.

    A null text stays null, texts without a secret stay as they are, rows that
    repeat are masked each, an empty table gives no rows, and further columns
    may have any name.
    """
    d, h, found, masked_text = unused(docs, "__d", "__h", "__spans", "__clean")
    spans = find_secrets(docs, rules)
    of = (spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("all"))
          .select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), F.col("all").alias(found)))
    of = written(of, "redact-spans")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.join(of, F.col("doc_id").cast("bigint").eqNullSafe(F.col(d))
                       & (F.xxhash64(text) == F.col(h)), "left")
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc, span):
        clear = F.greatest(acc["at"], span["start"])
        before = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (clear - acc["at"]).cast("int"))
        masked = F.when(span["start"] >= acc["at"], F.concat(acc["out"], before, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"), masked.alias("out"))

    def finish(acc):
        return F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text")))

    clean = F.when(F.col(found).isNull(), F.col("text")).otherwise(F.aggregate(found, state, step, finish))
    out = joined.withColumn(masked_text, clean)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col(masked_text).alias("text"))
        elif c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            columns.append(F.when(F.col(found).isNull(), F.col("n_chars"))
                           .otherwise(F.length(masked_text).cast(kind)).alias("n_chars"))
        else:
            columns.append(F.col(c))
    return out.select(*columns)
