"""Personal data in texts: patterns, and terms that give a protected entity away. DataFrame operations only.

Base spans are found by pattern. Each of them is a protected entity, and belongs to two wider ones, so that values seen once or
twice are scored too: its group (domain, network, issuer, country and area) and its kind. The terms of whole documents that hold
an entity are counted over the corpus: a term's pointwise mutual information with the entity, as a share of the entity's own
information content, says how much of it the term discloses (1: whoever reads the term knows the entity). Terms at or above the
threshold become spans too wherever they occur, and are generalised or removed with the entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fitted, stored

#: Kinds in order, and their patterns: matches are leftmost, non-overlapping and as long as can be. Runs are possessive, and
#: tried from their begin only (or where the last match ended), which changes no match but the work of failing.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
#: Code points on either side of an entity that tell near copies from other documents; documents in which a term must occur with it; disclosed share from which it counts.
CONTEXT, SUPPORT, DISCLOSED = 200, 3, 0.9
TERM = r"[\p{L}\p{N}]+"

_SPAN = "struct<kind:int,first:int,last:int,entity:string>"


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda done, i: done + F.when(i % 2 == 1, F.substring(turned, i, F.lit(1)).cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substring(turned, i, F.lit(1)).cast("int") + 1)),
    )
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.coalesce(part.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


#: Matches whose spans are added up in one array; arrays are copied at every step, so long ones are put together from these.
BLOCK = 256


def _placed(kind: int, name: str) -> Column:
    """Spans of all matches: what lies between them and they themselves, added up block by block."""
    between, match = F.col(f"{name}_between"), F.col(f"{name}_match")
    none = F.expr(f"cast(array() as array<{_SPAN}>)")
    gap, size = lambda i: F.length(F.element_at(between, i)), lambda i: F.length(F.element_at(match, i))
    inside = lambda k: F.sequence(k * BLOCK + 1, F.least(F.size(match), (k + 1) * BLOCK))
    blocks = F.sequence(F.lit(0), F.ceil(F.size(match) / BLOCK).cast("int") - 1)
    starts = F.aggregate(blocks, F.array(F.lit(0)), lambda done, k: F.concat(done, F.array(F.element_at(done, -1) + F.aggregate(inside(k), F.lit(0), lambda n, i: n + gap(i) + size(i)))))

    def block(start: Column, k: Column) -> Column:
        span = lambda at, i: F.struct(F.lit(kind).alias("kind"), (at + gap(i)).alias("first"), (at + gap(i) + size(i)).alias("last"), F.element_at(match, i).alias("entity")).cast(_SPAN)
        step = lambda done, i: F.struct((done["at"] + gap(i) + size(i)).alias("at"), F.concat(done["found"], F.when(_valid(name, F.element_at(match, i)), F.array(span(done["at"], i))).otherwise(none)).alias("found"))
        return F.aggregate(inside(k), F.struct(start.alias("at"), none.alias("found")), step)["found"]

    few = block(F.lit(0), F.lit(0))
    many = F.element_at(F.transform(F.array(starts), lambda at: F.flatten(F.transform(blocks, lambda k: block(F.element_at(at, k + 1), k)))), 1)
    return F.when(F.size(match) == 0, none).when(F.size(match) <= BLOCK, few).otherwise(many)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base``: its pattern spans by kind, then place; code points, end exclusive. Null texts have none.

    Patterns run only over texts with the characters they need.
    """
    none = F.expr("cast(array() as array<string>)")
    body = F.coalesce(F.col(text), F.lit(""))
    digit = body.rlike("[0-9]")
    needs = {"email": F.contains(body, F.lit("@")), "ip": digit & F.contains(body, F.lit(".")), "card": digit, "phone": F.contains(body, F.lit("+"))}
    for name, pattern in PATTERNS.items():
        docs = docs.withColumn(f"{name}_match", F.when(needs[name], F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(none))
    for name, pattern in PATTERNS.items():
        docs = docs.withColumn(f"{name}_between", F.when(F.size(f"{name}_match") > 0, F.split(body, pattern)).otherwise(none))
    docs = docs.withColumn("base", F.concat(*(_placed(k, name) for k, name in enumerate(PATTERNS))))
    return docs.drop(*(f"{name}_{x}" for name in PATTERNS for x in ("match", "between")))


def entities(base: Column) -> Column:
    """The distinct entities of a row's spans: of each its value, its group (domain, first two numbers of an address, first six
    digits of a card, first five of a phone number) and its kind."""
    digits = lambda s: F.regexp_replace(s["entity"], "[^0-9]", "")
    group = lambda s: F.when(s["kind"] == 0, F.substring_index(F.lower(s["entity"]), "@", -1)).when(s["kind"] == 1, F.substring_index(s["entity"], ".", 2)).when(s["kind"] == 2, F.substring(digits(s), 1, 6)).otherwise(F.substring(digits(s), 1, 5))
    name = lambda level, s, *value: F.concat_ws(":", F.lit(level), s["kind"].cast("string"), *value)
    return F.array_distinct(F.flatten(F.transform(base, lambda s: F.array(name("value", s, F.lower(s["entity"])), name("group", s, group(s)), name("kind", s)))))


def signs(found: DataFrame, text: str = "text") -> DataFrame:
    """``rid, sign``: a hash of the code points on both sides of all entities of a row. ``found`` has ``rid, base`` and the text."""
    spans = found.where(F.size("base") > 0).select("rid", text, F.explode("base").alias("span"))
    before = F.greatest(F.lit(0), F.col("span.first") - CONTEXT)
    sides = F.concat_ws("|", F.lower("span.entity"), F.substring(F.col(text), before + 1, F.col("span.first") - before), F.substring(F.col(text), F.col("span.last") + 1, F.lit(CONTEXT)))
    return spans.groupBy("rid").agg(F.xxhash64(F.array_sort(F.collect_set(F.xxhash64(sides)))).alias("sign"))


def units(found: DataFrame, text: str = "held") -> DataFrame:
    """``rid, unit, first, own, texts``: the unit that a row belongs to, whether it stands for it, whether it stands for its text
    there, and the unit's number of different texts. Equal texts are one unit, and so are rows whose entities have the same surroundings. ``found`` has ``rid, base, sum`` (a hash of the text) and the text of rows with spans."""
    unit = F.coalesce("sign", "sum")
    rows = found.select("rid", "sum").distinct().join(signs(found, text), "rid", "left").select("rid", "sum", unit.alias("unit"))
    each = rows.groupBy("unit", "sum").agg(F.min("rid").alias("own"))
    heads = each.groupBy("unit").agg(F.min("own").alias("head"), F.count("*").alias("texts"))
    held = rows.join(each, ["unit", "sum"]).join(heads, "unit")
    return held.select("rid", "unit", (F.col("rid") == F.col("head")).alias("first"), (F.col("rid") == F.col("own")).alias("own"), "texts")


def _distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _outside(text: Column, base: Column) -> Column:
    """The text without its base spans, which part terms as white space does."""
    ordered = F.array_sort(F.transform(base, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))
    kept = F.aggregate(
        ordered,
        start,
        lambda done, s: F.struct(F.greatest(done["at"], s["last"]).alias("at"), F.concat(done["parts"], F.array(F.substring(text, done["at"] + 1, F.greatest(F.lit(0), s["first"] - done["at"])))).alias("parts")),
    )
    return F.concat_ws(" ", kept["parts"], F.substring(text, kept["at"] + 1, F.length(text)))


def disclosing_terms(docs: DataFrame, found: DataFrame, unit: DataFrame, text: str = "text", support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """``entity, term, share``: terms that disclose an entity, from the rows ``found`` (``rid, base, held``) and the texts ``docs`` (``rid`` and text).

    All counts are of units, and a unit holds what any of its texts holds, so neither repetition in a text nor copies of
    it are evidence or hide any, and no text is left out. With N units, of which df(e) hold the entity and df(t) the term, and c that hold both:
    share = log(N c / (df(e) df(t))) / log(N / df(e)), at most 1.
    """
    own = found.where(F.size("base") > 0).join(unit.where("own").select("rid", "unit", "first", "texts"), "rid").dropDuplicates(["rid"])
    own = stored(own.select("unit", "first", "texts", entities(F.col("base")).alias("entities"), _distinct_terms(_outside(F.col("held"), F.col("base"))).alias("terms")), "pii-own")
    # the rows of a unit have the same entities
    holders = stored(own.where("first").select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("df_e")).where(F.col("df_e") >= support), "pii-holders")
    held = own.where("first").select("unit", F.explode("entities").alias("entity")).join(fitted(holders.select("entity")), "entity", "left_semi")
    pairs = held.join(own.where("texts = 1").select("unit", "terms"), "unit").select("entity", F.explode("terms").alias("term"))
    pairs = pairs.union(held.join(own.where("texts > 1").select("unit", F.explode("terms").alias("term")).distinct(), "unit").select("entity", "term"))
    both = stored(pairs.groupBy("entity", "term").agg(F.count("*").alias("c")).where(F.col("c") >= support), "pii-pairs")
    total = max(1, unit.where("first").count())
    wanted = stored(both.select("term").distinct(), "pii-terms")
    if wanted.isEmpty():
        return both.select("entity", "term", F.lit(0.0).alias("share"))
    # rows that only repeat a text of their unit are left out, units of several texts and rows that are there several times with the same key count once
    times = docs.groupBy("rid").agg(F.count("*").alias("times"))
    odd = stored(unit.join(times, "rid").where("not own or texts > 1 or times > 1").select("rid", "unit", "own"), "pii-odd")
    texts = docs.join(fitted(odd), "rid", "left")
    every = lambda rows: rows.select("unit", F.explode(_distinct_terms(F.col(text))).alias("term")).join(fitted(wanted), "term", "left_semi")
    single, repeated = every(texts.where(F.col("own").isNull())).groupBy("term").agg(F.count("*").alias("n")), every(texts.where("own")).distinct().groupBy("term").agg(F.count("*").alias("n"))
    spread = single.union(repeated).groupBy("term").agg(F.sum("n").alias("df_t"))
    known = both.join(spread, "term").join(holders, "entity")
    content = F.log(F.lit(float(total)) / F.col("df_e"))
    shared = F.log(F.lit(float(total)) * F.col("c") / (F.col("df_e") * F.col("df_t")))
    share = F.when(content > 0, F.least(F.lit(1.0), shared / content)).otherwise(0.0)
    return known.withColumn("share", share).where(F.col("share") >= disclosed).select("entity", "term", "share")


def places(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """``rid, terms``: spans of all places of the terms ``known`` in the texts ``docs`` (``rid`` and text); rows without any are left out.

    The forms that a text has are looked up first; only texts with some are cut at them.
    """
    forms = docs.select("rid", F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(TERM), F.lit(0)))).alias("form")).withColumn("term", F.lower("form"))
    hit = forms.join(fitted(known), "term", "left_semi").groupBy("rid").agg(F.array_join(F.array_sort(F.collect_set("form")), "|").alias("any"))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.col("any"), F.lit(r")(?![\p{L}\p{N}])"))
    cut = docs.join(fitted(hit), "rid").dropDuplicates(["rid"]).withColumn("pattern", pattern)
    cut = cut.select("rid", F.regexp_extract_all(text, "pattern", F.lit(0)).alias("form"), F.split(F.col(text), F.col("pattern"), -1).alias("between"))
    rows = cut.select("rid", F.posexplode(F.arrays_zip("form", F.transform(F.slice("between", F.lit(1), F.size("form")), lambda x: F.length(x)).alias("gap"))).alias("i", "x"))
    upto = F.sum(F.col("x.gap") + F.length("x.form")).over(Window.partitionBy("rid").orderBy("i"))
    last = upto.cast("int")
    placed = rows.select("rid", (last - F.length("x.form")).alias("first"), last.alias("last"), F.col("x.form").alias("form"))
    span = F.struct(F.lit(len(PATTERNS)).alias("kind"), "first", "last", F.col("form").alias("entity")).cast(_SPAN)
    return placed.groupBy("rid").agg(F.array_sort(F.collect_list(span)).alias("terms"))


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False, support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """Per row: ``key, base, terms`` (arrays of ``kind, first, last, entity``), and the text if asked.

    ``terms`` are the places of disclosing terms that lie in no base span, in any text. Null texts are empty.
    Rows that repeat key and text get the same spans; null keys are keys like others; an empty table gives an empty result;
    other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("rid", F.xxhash64("id", "body"))
    found = base_spans(rows, "body")
    found = found.withColumn("held", F.when(F.size("base") > 0, F.col("body"))).withColumn("sum", F.xxhash64("body"))
    found = stored(found if keep_text else found.drop("body"), "pii-base")
    unit = stored(units(found), "pii-units")
    texts = rows.select("rid", "body")
    known = stored(disclosing_terms(texts, found, unit, "body", support, disclosed), "pii-known")
    terms = places(texts, stored(known.select("term").distinct(), "pii-disclosing"), "body")
    out = found.join(terms, "rid", "left")
    clear = F.filter(F.coalesce("terms", F.expr(f"cast(array() as array<{_SPAN}>)")), lambda t: ~F.exists("base", lambda b: (b["first"] < t["last"]) & (t["first"] < b["last"])))
    return out.select(F.col("id").alias(key), *([F.col("body").alias(text)] if keep_text else []), "base", clear.alias("terms"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["first"].cast("string"), s["last"].cast("string"))), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, matches of each kind, SHA-256 of the base spans' list, and the list of all spans."""
    of_kind = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(PATTERNS)]
    return found.select(key, *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "terms")).alias("spans"))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """``key`` and ``text`` without personal data: entities give way to their kind, disclosing terms are generalised to
    ``[NAME]`` (capital letter first) or ``[NUMBER]``, and others are removed.

    Of spans that overlap the first one counts, and of those that begin together the shorter. Null texts become empty; null keys and rows that repeat
    are kept as they are; an empty table gives an empty result; other columns are left out."""
    found = find_personal_data(docs, key, text, keep_text=True, **parameters)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    ordered = F.array_sort(F.transform(F.concat("base", "terms"), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), s["kind"].alias("kind"), s["entity"].alias("entity"))))
    word = lambda s: F.when(s["kind"] < len(PATTERNS), F.element_at(names, s["kind"] + 1)).when(s["entity"].rlike("^[0-9]+$"), "[NUMBER]").when(s["entity"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("")
    built = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda done, s: F.when(s["first"] >= done["at"], F.struct(s["last"].alias("at"), F.concat(done["out"], F.substring(F.col(text), done["at"] + 1, s["first"] - done["at"]), word(s)).alias("out"))).otherwise(done),
    )
    return found.withColumn("built", built).select(key, F.concat(F.col("built.out"), F.substring(F.col(text), F.col("built.at") + 1, F.length(text))).alias(text))
