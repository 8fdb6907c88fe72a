"""Personal data and the terms that give it away, with DataFrame functions only.

Base entities are found by pattern. A term (word) is judged by the corpus: how
much of an entity's information content does the term give away? With distinct
texts as events (copies are one event), p the share of texts that hold an
entity, a term, or both,

    information of an entity   IC(e) = -log2 p(e)
    disclosed by a term        PMI(e; t) = log2 p(e, t) / (p(e) p(t))
    score                      PMI(e; t) / IC(e) * n(e, t) / (n(e, t) + c(t))

where c(t), the sightings that count as chance, is small for a term that looks
like a name or an identifier and 1 for any other word. A term whose score
reaches a threshold for some entity is sanitised wherever it stands: from
REMOVE_SHARE on it is removed, from GENERALISE_SHARE on it is replaced by its
class.

Scores depend on nothing but the sets of texts that hold an entity and a term,
so entities with the same set are one class, and terms likewise: texts pair
classes, not entities with words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Base patterns, written possessively: after a failed or finished run nothing is tried twice.
#: The look-behinds only skip starts inside a run, which fail or match as its start does.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # whole runs of 12 to 19 digits: a shorter or longer run is no card, so it need not be found
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to hold a kind at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = tuple(PATTERNS)
GENERALISE_SHARE = 0.65
REMOVE_SHARE = 0.9
#: Sightings beside an entity that count as chance: of a word, and of a term that looks like a name or an identifier.
CHANCE = 1.0
CHANCE_NAMED = 0.1
#: A word that no score can flag and that more than one text in so many holds is left out before words are joined;
#: there are at most FREQUENT times the mean number of different words a text of these.
FREQUENT = 1000
#: Matches whose places are added up in one go; the sums of such blocks are added up after that.
BLOCK = 32
_WORD = r"[^\p{L}\p{N}]+"
_RUN = r"[\p{L}\p{N}]++"
#: A capitalised word inside a sentence.
_NAME = r"(?<=[\p{L}\p{N},;]\x20)\p{Lu}[\p{L}\p{N}]*+"


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda part: F.regexp_like(part, F.lit("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _starts(gaps: str, matches: str) -> Column:
    """Where each match starts: after all gaps and matches before it.

    Sums run in blocks, so that no step copies more places than a block or the list of blocks has.
    """
    ints, lists, n = F.expr("cast(array() as array<int>)"), F.expr("cast(array() as array<array<int>>)"), F.size(matches)

    def add(acc: Column, i: Column) -> Column:
        at = acc["at"] + F.length(F.get(gaps, i))
        return F.struct((at + F.length(F.get(matches, i))).alias("at"), F.concat(acc["starts"], F.array(at)).alias("starts"))

    def block(b: Column) -> Column:
        return F.aggregate(F.sequence(b * BLOCK, F.least((b + 1) * BLOCK, n) - 1), F.struct(F.lit(0).alias("at"), ints.alias("starts")), add)

    def append(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x["at"]).alias("at"),
                        F.concat(acc["out"], F.array(F.transform(x["starts"], lambda s: s + acc["at"]))).alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), block)
    sums = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), lists.alias("out")), append)
    return F.when(n > 0, F.flatten(sums["out"])).otherwise(ints)


_SPAN = "array<struct<kind:int,s:int,e:int,value:string>>"


def _span(kind: int, at: str):
    def of(value: Column, i: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.get(at, i).alias("s"), (F.get(at, i) + F.length(value)).alias("e"), value.alias("value"))
    return of


def _checked(kind: str):
    return lambda x: _valid(kind, x["value"])


def _of_kind(kind: int):
    return lambda x: x["kind"] == kind


def with_base_spans(rows: DataFrame) -> DataFrame:
    """``rows`` (with a non-null ``text``) and ``base``: all valid base matches, by start, then kind.

    Per kind, matches are leftmost and do not overlap; positions are code
    points with exclusive ends. The text is cut at the matches, and what stands
    between them gives the positions.
    """
    text, all_kinds = F.col("text"), []
    for k, kind in enumerate(KINDS):
        m, g, at, pattern = f"_m{k}", f"_g{k}", f"_at{k}", PATTERNS[kind]
        none = F.expr("cast(array() as array<string>)")
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        rows = rows.withColumn(m, F.when(F.contains(text, F.lit(HINTS[kind])), found).otherwise(none) if HINTS[kind] else found)
        rows = rows.withColumn(g, F.when(F.size(m) > 0, F.split(text, pattern, -1)).otherwise(none)).withColumn(at, _starts(g, m))
        spans = F.transform(F.col(m), _span(k, at))
        all_kinds.append(F.filter(spans, _checked(kind)).cast(_SPAN))
    by_start = F.array_sort(F.concat(*all_kinds), lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["kind"] - b["kind"]))
    return rows.withColumn("base", by_start).drop(*[f"_{x}{k}" for x in ("m", "g", "at") for k in range(len(KINDS))])


def distinct_texts(rows: DataFrame) -> DataFrame:
    """The different texts of ``rows`` that are not empty, once each, with their base spans: (_text, text, base).

    Only texts that stand more than once are brought together, and combined within tasks first.
    """
    keyed = rows.where("text != ''").select(F.xxhash64("text").alias("_text"), "text")
    several = stored(keyed.groupBy("_text").agg(F.count("*").alias("n")).where("n > 1").select("_text"), "pii-several")
    again = keyed.join(several, "_text", "left_semi").groupBy("_text").agg(F.first("text").alias("text"))
    return stored(with_base_spans(keyed.join(several, "_text", "left_anti").unionByName(again)), "pii-texts")


def _words(texts: DataFrame) -> DataFrame:
    """Each text's different words outside what looks like an entity: (_text, term, form).

    form: 0 the word stands there in lower case, 2 capitalised inside a sentence, 1 otherwise.
    """
    rest = F.col("text")
    for kind, pattern in PATTERNS.items():
        cut = F.regexp_replace(rest, pattern, " ")
        rest = F.when(F.contains("text", F.lit(HINTS[kind])), cut).otherwise(rest) if HINTS[kind] else cut
    cased = texts.select("_text", rest.alias("rest")).select(
        "_text", F.array_distinct(F.split("rest", _WORD)).alias("cased"),
        F.array_distinct(F.transform(F.regexp_extract_all("rest", F.lit(_NAME), F.lit(0)), F.lower)).alias("names"))
    lowered = cased.withColumn("lowered", F.array_distinct(F.transform("cased", F.lower)))
    capital = lowered.select("_text", "names", F.array_intersect("lowered", "cased").alias("plain"), F.array_except("lowered", "cased").alias("capital"))

    def formed(terms: Column, form: int) -> Column:
        return F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(form).alias("form")))

    found = F.concat(formed(F.col("plain"), 0), formed(F.array_except("capital", "names"), 1), formed(F.array_intersect("capital", "names"), 2))
    return capital.select("_text", F.inline(found)).where("term != ''")


def _same_texts() -> list[Column]:
    """A class: how many texts, and two sums over them without carry."""
    return [F.count("*").alias("n"), F.bit_xor("_text").alias("a"), F.bit_xor(F.xxhash64("_text", F.lit(1))).alias("b")]


def _entity(kind: Column, value: Column) -> Column:
    return F.concat_ws(":", kind.cast("string"), F.lower(value))


def disclosing_terms(texts: DataFrame, generalise: float = GENERALISE_SHARE, remove: float = REMOVE_SHARE) -> tuple[DataFrame, DataFrame]:
    """Terms that give an entity away: (term, share: the best score, removed or generalised); and the words too frequent for it.

    ``texts`` are those of ``distinct_texts``; counts are over all of them.
    """
    spark, n = texts.sparkSession, float(texts.count())
    held = texts.where(F.size("base") > 0)
    beside = stored(held.select("_text", F.explode("base").alias("x")).select("_text", _entity(F.col("x.kind"), F.col("x.value")).alias("entity"))
                    .distinct(), "pii-entities")
    entities = stored(beside.groupBy("entity").agg(*_same_texts()).where(F.col("n") < F.lit(n)), "pii-entity-texts")
    widest = entities.agg(F.max("n")).first()[0]
    if widest is None:
        return (spark.createDataFrame([], "term string, share double, removed boolean"), spark.createDataFrame([], "term string"))

    # no entity is held by more than ``widest`` texts: what the best one could give bounds a term's score
    chance = (F.when((F.col("form") == 2) | (F.rlike("term", F.lit(r"\p{L}")) & F.rlike("term", F.lit(r"\p{N}"))), F.lit(CHANCE_NAMED))
              .otherwise(F.lit(CHANCE)))
    seen = F.least(F.col("n"), F.lit(widest))
    most = seen / (seen + F.col("chance")) * F.log2(F.lit(n) / F.greatest(F.col("n"), F.lit(widest))) / F.log2(F.lit(n) / F.lit(float(widest)))
    stats = _words(texts).groupBy("term").agg(*_same_texts(), F.when(F.min("form") > 0, F.max("form")).otherwise(0).alias("form"))
    stats = stats.withColumn("chance", chance).drop("form").withColumn("able", most >= F.lit(generalise - 1e-9))
    stats = stored(stats.where(F.col("able") | (F.col("n") > F.lit(n / FREQUENT))), "pii-words")
    frequent = stats.where("not able").select("term")
    able = stats.where("able").drop("able")

    of_text = ["n", "a", "b"]
    entity_sets = beside.join(entities, "entity").select("_text", F.struct(*of_text).alias("e")).distinct()
    term_sets = (_words(held).select("_text", "term").join(F.broadcast(frequent), "term", "left_anti").join(able, "term")
                 .select("_text", F.struct(*of_text, "chance").alias("t")).distinct())
    both = entity_sets.join(term_sets, "_text").groupBy("e", "t").agg(F.count("*").alias("n_et"))
    told = F.log2(F.col("n_et") * F.lit(n) / (F.col("e.n") * F.col("t.n"))) / F.log2(F.lit(n) / F.col("e.n"))
    score = told * F.col("n_et") / (F.col("n_et") + F.col("t.chance"))
    best = both.withColumn("share", score).groupBy("t").agg(F.max("share").alias("share")).where(F.col("share") >= F.lit(generalise))
    terms = able.join(best.select("t.*", "share"), [*of_text, "chance"]).select("term", "share", (F.col("share") >= remove).alias("removed"))
    return stored(terms, "pii-terms"), frequent


def with_spans(texts: DataFrame, terms: DataFrame, frequent: DataFrame) -> DataFrame:
    """(_text, base, all): base spans, and those with the spans of disclosing terms, of every text of ``distinct_texts``."""
    shape = "array<struct<kind:int,s:int,e:int>>"
    # places are found where the text is: what is joined with the terms are words and places, not texts
    cut = (texts.select("_text", F.regexp_extract_all("text", F.lit(_RUN), F.lit(0)).alias("_m"), F.split("text", _RUN, -1).alias("_g"))
           .withColumn("_at", _starts("_g", "_m")))
    placed = (cut.select("_text", F.inline(F.arrays_zip(F.transform("_m", F.lower).alias("term"), F.col("_at").alias("s"), F.col("_m").alias("word"))))
              .select("_text", "term", "s", (F.col("s") + F.length("word")).alias("e")))
    kind = F.when(F.col("removed"), len(KINDS) + 1).otherwise(len(KINDS))
    more = stored(placed.join(F.broadcast(frequent), "term", "left_anti").join(terms, "term").groupBy("_text")
                  .agg(F.collect_list(F.struct(kind.alias("kind"), "s", "e")).cast(shape).alias("_more")), "pii-term-spans")
    base = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["s"].alias("s"), b["e"].alias("e"))).cast(shape)
    every = F.concat(base, F.coalesce("_more", F.expr(f"cast(array() as {shape})")))
    by_start = F.array_sort(every, lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["kind"] - b["kind"]))
    return texts.select("_text", "base").join(more, "_text", "left").select("_text", "base", by_start.alias("all"))


_NAMES = [*KINDS, "term", "term"]


def _written(spans: str) -> Column:
    names = F.array(*[F.lit(n) for n in _NAMES])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE_SHARE,
             remove: float = REMOVE_SHARE) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans and the sanitised ``text`` of every row.

    Entities become their kind in brackets, generalised terms ``[word]`` or
    ``[number]``, removed terms nothing; of overlapping spans the first decides.
    Null and empty texts hold nothing (the digest is that of an empty string).
    A null id stays null; repeated rows and texts give repeated results and are
    one event. Very long texts are handled whole, in time that grows with their
    length. Only the two columns named are read.
    """
    rows = _rows(docs, id_col, text_col)
    texts = distinct_texts(rows)
    spans = with_spans(texts, *disclosing_terms(texts, generalise, remove))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def put(block: Column):
        def step(acc: Column, x: Column) -> Column:
            piece = F.substring(block["rest"], acc["at"] - block["at"] + 1, x["s"] - acc["at"])
            value = F.substring(block["rest"], x["s"] - block["at"] + 1, x["e"] - x["s"])
            by = (F.when(x["kind"] < len(KINDS), F.get(names, x["kind"])).when(x["kind"] == len(KINDS) + 1, F.lit(""))
                  .when(F.regexp_like(value, F.lit(r"^\p{N}+$")), F.lit("[number]")).otherwise(F.lit("[word]")))
            return F.when(x["s"] < acc["at"], acc).otherwise(F.struct(x["e"].alias("at"), F.concat(acc["out"], piece, by).alias("out")))
        return step

    def put_block(acc: Column, b: Column) -> Column:
        # the text is cut once per block: within it, only the block's stretch is counted through
        inner = F.aggregate(F.slice("all", b * BLOCK + 1, F.lit(BLOCK)), F.struct(acc["at"].alias("at"), F.lit("").alias("out")), put(acc))
        return F.struct(inner["at"].alias("at"), F.concat(acc["out"], inner["out"]).alias("out"),
                        F.substring(acc["rest"], inner["at"] - acc["at"] + 1, F.length(acc["rest"])).alias("rest"))

    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.col("text").alias("rest"))
    blocks = F.sequence(F.lit(0), F.floor(F.size("all") / BLOCK).cast("int"))
    done = (texts.select("_text", "text").join(spans, "_text").withColumn("_done", F.aggregate(blocks, state, put_block))
            .select("_text", "base", "all", F.concat("_done.out", "_done.rest").alias("text")))
    return _keyed(rows).join(done, "_text", "left").select("doc_id", *_digest(), F.coalesce("text", F.lit("")).alias("text"))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.xxhash64("text").alias("_text"))


def _digest() -> list[Column]:
    counts = [F.coalesce(F.size(F.filter("base", _of_kind(k))).cast("long"), F.lit(0).cast("long")).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return [*counts, F.sha2(F.coalesce(_written("base"), F.lit("")).cast("binary"), 256).alias("base_sha256"),
            F.coalesce(_written("all"), F.lit("")).alias("spans")]


def personal_data_of(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of all documents; edge cases as ``sanitise``."""
    rows = _rows(docs, "doc_id", "text")
    texts = distinct_texts(rows)
    spans = with_spans(texts, *disclosing_terms(texts))
    return _keyed(rows).join(spans, "_text", "left").select("doc_id", *_digest())
