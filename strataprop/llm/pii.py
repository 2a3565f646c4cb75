"""Personal data: four fixed kinds, and more of them by patterns bootstrapped from their contexts.

Fixed patterns find e-mail addresses, IP addresses, card numbers and phone numbers. These entities are
seeds. The words left of a seed, alone or with the shape of the token, are lexical patterns; every
token with a digit or an at-sign, or run of such tokens, is an instance of the patterns it stands in. Pattern and instance
scores are taken from one another for a few rounds, and instances of patterns that end with a high
score and enough seeds are reported as the pattern's kind. All of it is DataFrame operations: matches
are exploded, and their places are running sums within a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage
from strataprop.llm.names import free_name
from strataprop.operators.joins import equi_join, find_hot_keys

#: Kinds in the order of the output.
KINDS = ("email", "ip", "card", "phone")
#: What counts as an entity. Possessive repeats and look-behinds only keep Java from
#: trying starts and ends that cannot match; the matches are the same.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A token that could be an identifier.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*"
#: A token that another group of the same identifier may follow, and what may stand between two groups:
#: a space, or the bank's letters in an account number.
GROUP, BETWEEN = r"^[^@]*[^@,;:!?.]$", r"^ (?:[A-Z]{4} )?$"

#: A context word counts by its last 40 characters; so many hold two of them, however far apart they were.
WORD, CONTEXT = 40, 83
#: Rounds of scoring, the score from which on a pattern is trusted, and its fewest distinct seeds.
ROUNDS, TRUST, SEEDS = 3, 0.8, 5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum holds: from the right, every second digit doubled, its digits added."""
    turned = F.reverse(digits)
    back = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda k: turned.substr(k, F.lit(1)).cast("int"))
    worth = F.transform(back, lambda d, k: F.when(k % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    n = F.length(digits)
    byte = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return (F.when(kind == "ip", value.rlike(rf"^{byte}(?:\.{byte}){{3}}$"))
            .when(kind == "card", n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(8, 15))
            .otherwise(True))


def _last_words(text: Column) -> Column:
    """The end of a text that holds its last two words, however many blanks there are and however long the words."""
    end = F.substring(text, -CONTEXT, CONTEXT)
    short = F.regexp_replace(F.regexp_replace(text, r"\s+", " "), rf"(?<!\S)(?=\S{{{WORD + 1}}})\S+(?=\S{{{WORD}}})", "")
    # few texts need the longer way: an end of single blanks and short words has both words whole
    return F.when(end.rlike(rf"\s\s|\S{{{WORD + 1}}}"), F.substring(short, -CONTEXT, CONTEXT)).otherwise(end)


def _pair(gap: Column, value: Column) -> Column:
    return F.struct(F.length(gap).cast("long").alias("skip"), value.alias("value"),
                    F.substring(gap, -CONTEXT, CONTEXT).alias("gap"), _last_words(gap).alias("end"),
                    _last_words(F.concat(gap, value)).alias("piece"))


def _numbered(pairs: Column, back: int) -> Column:
    """Each match with its number and the text before it, the ``back`` matches before it included."""
    def number(all_pairs: Column, pair: Column, k: Column) -> Column:
        first = F.greatest(k - back, F.lit(0))
        pieces = F.transform(F.slice(all_pairs, first + 1, k - first), lambda p: p["piece"])
        before = _last_words(F.concat(F.array_join(pieces, ""), pair["end"]))
        return F.struct(k.alias("number"), pair.alias("pair"), before.alias("before"))

    # bound to a variable first: an expression inside a lambda is worked out again for each element
    return F.flatten(F.transform(F.array(pairs), lambda all_pairs: F.transform(
        all_pairs, lambda pair, k: number(all_pairs, pair, k))))


def _of_kind(numbered: Column, kind: str) -> Column:
    matched = F.filter(numbered, lambda m: m["pair"]["value"].isNotNull())
    return F.transform(matched, lambda m: F.struct(
        F.lit(kind).alias("kind"), m["number"].alias("number"), m["pair"]["value"].alias("value"),
        m["pair"]["skip"].alias("skip"), m["pair"]["gap"].alias("gap"), m["before"].alias("before")))


def _matches(docs: DataFrame) -> DataFrame:
    """A row for each match in each distinct row: its kind, value, place, and the two words before."""
    found = []
    for kind, pattern in (PATTERNS | {"token": TOKEN}).items():
        # what lies between the matches, and the matches: together they are the text
        pairs = F.zip_with(F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), _pair)
        # a token is a word of its own; other matches can stand side by side in one, with a character each at least
        found.append(_of_kind(_numbered(pairs, 2 if kind == "token" else CONTEXT), kind))
    rows = docs.select("row", "row2", F.explode(F.concat(*found)).alias("m")).select("row", "row2", "m.*")
    rows = rows.withColumn("near", F.lower(F.regexp_extract("before", r"(\S+)\s*$", 1))).withColumn(
        "left", F.lower(F.regexp_extract("before", r"(\S+\s+\S+)\s*$", 1)))
    rows = rows.dropDuplicates(["row", "row2", "kind", "number"])
    so_far = Window.partitionBy("row", "row2", "kind").orderBy("number")
    end = F.sum(F.col("skip") + F.length("value")).over(so_far)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))


def _patterns(rows: DataFrame) -> DataFrame:
    """One row for each pattern a value stands in: the two words before; the word before and the shape."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        "value", "[0-9]+", "9"), r"\p{Lu}+", "A"), r"\p{Ll}+", "a")
    words = F.when(F.col("left") != "", F.concat(F.lit("words:"), F.regexp_replace("left", r"\s+", " ")))
    shaped = F.when(F.col("near") != "", F.concat(F.lit("shape:"), "near", F.lit(" "), shape))
    return rows.withColumn("pattern", F.explode(F.array_compact(F.array(words, shaped))))


def _instances(free: DataFrame) -> DataFrame:
    """Runs of neighbouring free tokens, and the tokens of longer runs once more by themselves.

    ``run`` is the number of a run's first token, ``whole`` tells a run from a part of one. The first
    part has only the word before, since its run has the same two words.
    """
    in_text = Window.partitionBy("row", "row2").orderBy("number")
    follows = ((F.lag("number").over(in_text) == F.col("number") - 1)
               & F.lag(F.col("value").rlike(GROUP)).over(in_text) & ~F.col("value").contains("@")
               & (F.col("skip") <= 6) & F.col("gap").rlike(BETWEEN))
    first = F.when(F.coalesce(follows, F.lit(False)), None).otherwise(F.col("number"))
    runs = free.withColumn("run", F.last(first, ignorenulls=True).over(in_text)).groupBy("row", "row2", "run").agg(
        F.sort_array(F.collect_list(F.struct("number", "start", "end", "value", "gap", "near", "left"))).alias("parts"))
    parts, head = F.col("parts"), F.col("parts")[0]
    value = F.concat(head["value"], F.array_join(F.transform(
        F.slice("parts", F.lit(2), F.size("parts")), lambda p: F.concat(p["gap"], p["value"])), ""))

    def instance(p: Column, end: Column, value: Column, left: Column, whole: bool) -> Column:
        return F.struct(p["start"].alias("start"), end.alias("end"), value.alias("value"), p["near"].alias("near"),
                        left.alias("left"), F.lit(whole).alias("whole"))

    whole = F.array(instance(head, F.element_at("parts", -1)["end"], value, head["left"], True))
    single = F.transform(parts, lambda p, k: instance(
        p, p["end"], p["value"], F.when(k > 0, p["left"]).otherwise(""), False))
    both = F.when(F.size("parts") > 1, F.concat(whole, single)).otherwise(whole)
    return runs.select("row", "row2", "run", F.explode(both).alias("i")).select("row", "row2", "run", "i.*")


def _discovered(base: DataFrame, tokens: DataFrame, rounds: int, trust: float, seeds: int) -> DataFrame:
    """Tokens outside the base spans that stand in a trusted pattern, each with one kind."""
    # a token is free if all base spans before it end by its start, and all behind it begin at its end
    both = tokens.withColumn("seed", F.lit(False)).unionByName(base.withColumn("seed", F.lit(True)))
    of_text = Window.partitionBy("row", "row2")
    ended = F.max(F.when(F.col("seed"), F.col("end"))).over(of_text.orderBy("start", "end"))
    begun = F.min(F.when(F.col("seed"), F.col("start"))).over(of_text.orderBy(F.desc("start"), F.desc("end")))
    free = both.withColumn("ended", ended).withColumn("begun", begun).filter(
        ~F.col("seed") & (F.coalesce("ended", F.lit(0)) <= F.col("start"))
        & F.coalesce(F.col("begun") >= F.col("end"), F.lit(True)))
    standing = stage(_patterns(_instances(free)).select(
        "row", "row2", "run", "whole", "value", "start", "end", "pattern"))
    # instances of a pattern count once, however often they occur
    known = _patterns(base).select("pattern", "value", "kind").distinct()
    seeded = stage(known.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= seeds))
    edges = stage(equi_join(standing.select("pattern", "value").distinct(), seeded, "pattern", "left_semi"))
    # a value can stand in very many patterns, and a pattern around very many values
    hot = find_hot_keys(edges, ["value"])
    unknown = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("others"))
    others = F.coalesce("others", F.lit(0))
    scored = seeded.join(unknown, "pattern", "left").select(
        "pattern", "kind", "seeds", others.alias("others"),
        (F.col("seeds") / (F.col("seeds") + others)).alias("score"))
    for _ in range(rounds):
        scored = stage(scored)
        # an instance is as likely as it is that one of its patterns is right
        near = equi_join(edges, scored.select("pattern", "kind", "score"), "pattern", "inner")
        belief = near.groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("belief"))
        gained = equi_join(edges, belief, "value", "inner", hot=hot).groupBy("pattern", "kind").agg(F.sum("belief").alias("gained"))
        scored = scored.drop("score").join(gained, ["pattern", "kind"], "left").withColumn(
            "score", (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("seeds") + F.col("others") + 1))
        scored = scored.select("pattern", "kind", "seeds", "others", "score")
    best = stage(scored.filter(F.col("score") >= trust).groupBy("pattern").agg(
        F.max(F.struct("score", F.negative(_order(F.col("kind"))).alias("place"), "kind")).alias("best")))
    found = equi_join(standing, best, "pattern", "inner").groupBy("row", "row2", "run", "whole", "start", "end", "value").agg(
        F.max("best").alias("best"))
    # a part says nothing more once its run is found
    run_found = F.max("whole").over(Window.partitionBy("row", "row2", "run"))
    return found.withColumn("run_found", run_found).filter(F.col("whole") | ~F.col("run_found")).select(
        "row", "row2", F.col("best.kind").alias("kind"), "start", "end", "value")


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
             trust: float = TRUST, seeds: int = SEEDS) -> DataFrame:
    """``spans`` of every row: array of (kind, start, end, base), by kind, then start.

    Places are code points, the end exclusive. ``base`` tells the fixed patterns' spans from those that
    bootstrapped patterns add; an added span overlaps no base span of its text, may have several groups
    with a space between, and quotes and punctuation around it are left out. Its context is the two words before it, however
    far; a word beyond 40 characters counts by its last 40. Spans of different kinds may overlap. A null or empty text has an
    empty array. Rows with equal key and text have equal spans; a null key is a key. An empty table
    gives no rows. ``row`` and ``row2`` name the row's key and text in joins; other columns are not carried.
    """
    rows = _named(docs, key, text)
    matches = stage(_matches(rows))
    base = matches.filter("kind <> 'token'").filter(_valid(F.col("kind"), F.col("value")))
    added = _discovered(base, matches.filter("kind = 'token'"), rounds, trust, seeds)
    lead = F.length(F.regexp_extract("value", r"^([\"'(\[<{]*)", 1))
    tail = F.length(F.regexp_extract("value", r"([\"')\]>}.,;:!?]*)$", 1))
    added = added.withColumn("start", F.col("start") + lead).withColumn("end", F.col("end") - tail).filter("end > start")
    columns = ["row", "row2", "kind", "start", "end"]
    spans = base.select(*columns, F.lit(True).alias("base")).union(
        added.select(*columns, F.lit(False).alias("base")))
    ordered = F.sort_array(F.collect_set(F.struct(_order(F.col("kind")).alias("place"), "start", "end", "kind", "base")))
    of_row = spans.groupBy("row", "row2").agg(ordered.alias("found"))
    named = F.transform(F.coalesce("found", F.array()), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))
    return rows.select("key", "row", "row2").join(of_row, ["row", "row2"], "left").select(
        F.col("key").alias(key), "row", "row2", named.alias("spans"))


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text with 96 bits of hash that name them in joins."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("key"), body.alias("text"),
                       F.xxhash64(F.col(key), body).alias("row"), F.hash(body, F.col(key)).alias("row2"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, with ``[kind]`` in the text in place of every span.

    Spans that overlap give one mark, of the first. A null text stays null.
    """
    found = find_pii(docs, key, text).filter(F.size("spans") > 0)
    of_row, of_row2, spans = (free_name(docs, name) for name in ("__row", "__row2", "__spans"))
    found = found.select(F.col("row").alias(of_row), F.col("row2").alias(of_row2),
                         F.col("spans").alias(spans)).dropDuplicates([of_row, of_row2])
    body = F.coalesce(docs[text], F.lit(""))
    joined = docs.join(found, (F.xxhash64(docs[key], body) == F.col(of_row))
                       & (F.hash(body, docs[key]) == F.col(of_row2)), "left")
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    empty = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def step(so_far: Column, span: Column) -> Column:
        start, end = span["start"], span["end"]
        more = F.concat(so_far["text"], F.substring(body, (so_far["at"] + 1).cast("int"), (start - so_far["at"]).cast("int")),
                        F.lit("["), span["kind"], F.lit("]"))
        return F.struct(F.when(start < so_far["at"], so_far["text"]).otherwise(more).alias("text"),
                        F.greatest(so_far["at"], end).alias("at"))

    marked = F.aggregate(by_start, empty, step, lambda end: F.concat(
        end["text"], F.substring(body, (end["at"] + 1).cast("int"), F.length(body))))
    return joined.select(*[F.when(F.col(spans).isNotNull(), marked).otherwise(docs[text]).alias(text)
                           if c == text else docs[c] for c in docs.columns])
