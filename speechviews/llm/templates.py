"""Benchmark decontamination by template canonicalisation; DataFrame functions only.

A text becomes tokens without case and punctuation. Numbers (digits or words), units after a number, and capitalised words
are typed slots: names inside a sentence always, words that open one in a second template only, as they may be names
or not. All windows of ``WINDOW`` tokens are hash-joined with those of the benchmark in three forms: literally, as a template with
names inside sentences, and as one with all capitalised words. Windows are hashed; strings are compared for
those whose hashes meet. Windows on one diagonal (same distance between the positions in document and item) form a
passage, in which every slot value of the item must stand for one value of the document. So a question with other numbers or
names is caught, in any letter case if it is a copy, and a passage whose slots contradict each other is not. A passage counts
when it has ``NEEDED`` windows, or all that the item has.

Templates of more than ``MOST_SLOTS`` slots say too little and are not joined; in their place go longer windows, which reach
to the ``WINDOW - MOST_SLOTS``-th literal token. A passage of templates alone needs ``NEEDED``, or all templates that the
item has.

Items of fewer than ``WINDOW`` tokens are one window of their own length; those under ``SHORTEST`` tokens are found in
documents that have no other tokens. Null or empty texts match nothing; null ids and repeated rows are judged by their
text. An empty table gives no rows, an empty benchmark no leaks. The benchmark is broadcast only when it is proven small.

Texts are searched in blocks of ``BLOCK`` starts of windows, and a window that met one of an item goes on with its own tokens alone:
memory does not grow with the number of passages in a text.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from speechviews.llm.common import stored, text_or_empty, whole_row
from speechviews.session import broadcast_if_small

WINDOW = 8
NEEDED = 3
MOST_SLOTS = 4
SHORTEST = 4
BLOCK = 512
NAME, OPENING, NUMBER, UNIT = "\x01", "\x02", "\x03", "\x04"  # so that marked texts are ASCII or Latin-1 where texts are
MARKS = NAME + OPENING + NUMBER + UNIT
PRIVATE = "\ue000\ue001\ue002\ue003"  # marks while a text that has the others itself is worked on, and in SQL; dropped from texts
#: Units recognised after a number (fixed values).
UNITS = (
    "mm|cm|m|km|in|ft|yd|mi|inch|inches|foot|feet|yard|yards|mile|miles|meter|meters|metre|metres|kilometer|kilometers|"
    "mg|g|kg|t|oz|lb|lbs|gram|grams|kilogram|kilograms|ounce|ounces|pound|pounds|ton|tons|"
    "ml|l|liter|liters|litre|litres|gallon|gallons|"
    "s|sec|min|h|hr|hrs|second|seconds|minute|minutes|hour|hours|day|days|week|weeks|month|months|year|years|"
    "percent|degrees|dollars|cents|euros|usd|eur|kmh|mph|kwh|w|kw|v|hz|kb|mb|gb|tb"
)
#: Numbers written as words (fixed values); "one" is a pronoun too often.
NUMBER_WORDS = (
    "zero|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|"
    "twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred|thousand|million|billion"
)
FORMS = ("literal", "named", "opened")


def _by_first_letter(words):
    """The alternatives grouped by their first letter, so that most tokens fail at once."""
    rest = {}
    for word in words.split("|"):
        rest.setdefault(word[0], []).append(word[1:])
    return f"(?=[{''.join(rest)}])(?:{'|'.join(f'{first}(?:{'|'.join(ends)})' for first, ends in rest.items())})"


def _has(text, characters):
    """Whether a text holds one of the characters; bytes are searched, no pattern is run."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in characters])


def _replaced(text, characters, by=""):
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(by)), characters, text)


def _marked(text, marks):
    """Each step stands once in the next one: a step that is named twice is computed twice."""
    name, opening, number, unit = marks
    first, ends = rf" [^\p{{L}}\p{{N}} {marks}]*", r"(?![\p{L}\p{N}])"
    t = F.regexp_replace(_replaced(F.concat(F.lit(" "), text), "\t\n\x0b\f\r", " "), " {2,}", " ")
    t = _replaced(F.regexp_replace(t, r" [^\p{L}\p{N} ]+(?= |$)", ""), PRIVATE)
    digits, words = r"\p{N}[^\p{L} ]*(?=[ ]|$)", rf"(?i:{_by_first_letter(NUMBER_WORDS)})(?=[^\p{{L}}\p{{N}} ]*(?:[ ]|$))"
    t = F.regexp_replace(t, f"{first}({digits}|{words})", f" {number}$1")
    t = F.regexp_replace(t, rf"({number}[^ ]+ )((?i:{UNITS})){ends}", f"$1{unit}$2")
    t = F.regexp_replace(t, rf"{first}(\p{{Lu}}\p{{Ll}}+){ends}", f" {opening}$1")
    t = F.lower(F.regexp_replace(t, rf" {opening}(?<=[\p{{Ll}}\p{{N}},] {opening})", f" {name}"))
    ascii_marks = "".join(rf"\x{ord(c):02x}" for c in map(chr, range(128)) if not c.isalnum() and c not in f"{marks} ")
    t = F.regexp_replace(t, f"[{ascii_marks}]+", "")  # single characters are looked up in a table
    return F.trim(F.regexp_replace(t, rf"[^\x00-\x7f\p{{L}}\p{{N}}{marks}]+", ""))


def marked(text):
    """The text's tokens separated by one blank; a slot is its type's mark and its value.

    Patterns start with the blank before a token, which is found without trying them at every character.
    """
    return F.when(_has(text, MARKS), F.translate(_marked(text, PRIVATE), PRIVATE, MARKS)).otherwise(_marked(text, MARKS))


def forms(texts: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``w``: the tokens literally, as templates with names, and with all capitalised words; no empty texts.

    A form that equals the literal tokens is null in ``w``. Exploding an array of one element gives a value a name that the
    optimiser keeps, so it is computed once.
    """
    found = texts.select(*columns, F.explode(F.array(marked(text_or_empty()))).alias("t")).where("t <> ''")
    slots, without = _has(F.col("t"), NAME + NUMBER + UNIT), lambda t: F.replace(t, F.lit(OPENING), F.lit(""))
    template = F.when(slots, F.regexp_replace("t", rf"([{NAME}{NUMBER}{UNIT}])[^ ]*", "$1")).otherwise(F.col("t"))
    literal = F.when(slots, F.regexp_replace("t", f"[{MARKS}]", "")).otherwise(without(F.col("t")))
    split = [F.split(literal, " ").alias("literal"), F.when(slots, F.split(without(template), " ")).alias("named"),
             F.when(slots | _has(F.col("t"), OPENING), F.split(F.regexp_replace(template, rf"{OPENING}[^ ]*", NAME), " ")).alias("opened")]
    return found.select(*columns, F.explode(F.array(F.struct(*split))).alias("w"))


def _form(name):
    return F.coalesce(f"w.{name}", "w.literal")


def _is_slot(token):
    return token.isin(NAME, NUMBER, UNIT)


def _slots(tokens):
    return F.size(F.filter(tokens, _is_slot))


def _hashes(tokens):
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _part(tokens, pos, length):
    return F.slice(tokens, pos + 1, length)


def long_windows(texts: DataFrame, longest=None) -> DataFrame:
    """``pos, length`` beside the columns of ``texts``: windows of more than ``WINDOW`` tokens, ``longest`` at most.

    For each literal token, ``begin`` to ``end`` are the starts of windows whose last token is some literal tokens on.
    """
    columns = texts.columns
    literal = F.array_remove(F.transform(_form("named"), lambda t, i: F.when(_is_slot(t), 0).otherwise(i + 1)), 0)
    found = texts.select(*columns, F.explode(F.array(literal)).alias("at"))
    starts = F.zip_with(F.concat(F.array(F.lit(0)), F.col("at")), F.col("at"), lambda a, b: F.struct(a.alias("before"), b.alias("first")))
    ends = F.slice("at", WINDOW - MOST_SLOTS, F.size("at"))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(s["before"].alias("before"), s["first"].alias("first"), e.alias("last")))
    found = found.select(*columns, F.explode(F.filter(runs, lambda r: r["last"] - r["before"] > WINDOW)).alias("run"))
    begin = F.col("run.before") if longest is None else F.greatest("run.before", F.col("run.last") - longest)
    found = found.withColumn("begin", begin).withColumn("end", F.least(F.col("run.first"), F.col("run.last") - WINDOW)).where("begin < end")
    return found.select(*columns, F.col("run.last").alias("last"), F.explode(F.sequence("begin", F.col("end") - 1)).alias("pos")).select(
        *columns, "pos", (F.col("last") - F.col("pos")).alias("length"))


def blocks(texts: DataFrame, longest) -> DataFrame:
    """``n, start`` beside the columns of ``texts``, whose ``w`` is cut into the windows of ``longest`` tokens at most that begin at ``BLOCK`` places.

    A compiled stage holds all rows that it makes of one row; what it makes of a block is bounded, what it makes of a text is not.
    """
    columns = [c for c in texts.columns if c != "w"]
    n = F.size("w.literal")
    found = texts.select(*columns, "w", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1, F.lit(BLOCK))).alias("start"))
    parts = [_part(F.col(f"w.{form}"), F.col("start"), BLOCK + longest - 1).alias(form) for form in FORMS]
    return found.select(*columns, "n", "start", F.struct(*parts).alias("w"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``key, h, item_id, item_pos, length, is_long, is_template, slots, needed, needed_templates``, a row for each form of each window.

    ``slots`` holds the places and values of a window's slots.
    """
    items = stored(forms(benchmark, "item_id").distinct().withColumn("item_key", F.xxhash64("w")), "benchmark-tokens")
    columns, n = ["item_id", "item_key"], F.size("w.literal")
    size = F.least(F.lit(WINDOW), n)

    def cut(rows, is_long):
        # An exploded value, as in `_met`: else a compiled stage holds the whole item with each of its windows.
        parts = F.struct(*[_part(_form(form), F.col("pos"), F.col("length")).alias(form) for form in FORMS])
        rows = rows.select(*columns, "pos", "length", F.lit(is_long).alias("is_long"), F.explode(F.array(parts)).alias("window"))
        return rows.select(*columns, "pos", "length", "is_long", "window.*")

    short = cut(items.select(*columns, "w", size.alias("length"), F.explode(F.sequence(F.lit(0), n - size)).alias("pos")), False)
    every = short.unionByName(cut(long_windows(items), True))
    few = {form: _slots(F.col(form)) <= MOST_SLOTS for form in FORMS[1:]}
    is_template = F.col("is_long") | few["named"]
    every = every.withColumn("is_template", is_template)
    counts = every.groupBy("item_id", "item_key").agg(F.sum((~F.col("is_long")).cast("long")).alias("n_windows"), F.sum(F.col("is_template").cast("long")).alias("n_templates"))
    keys = F.when(F.col("is_long"), F.array("named")).otherwise(F.array_distinct(F.array_compact(F.array(
        F.col("literal"), *[F.when(few[form], F.col(form)) for form in FORMS[1:]]))))
    places = F.filter(F.transform("opened", lambda t, i: F.when(_is_slot(t), F.struct(i.alias("at"), F.get("literal", i).alias("value")))), lambda s: s.isNotNull())
    every = every.select("item_id", "item_key", F.col("pos").alias("item_pos"), "length", "is_long", "is_template", places.alias("slots"), F.explode(keys).alias("tokens"))
    needed = [F.least(F.lit(NEEDED), n).alias(a) for n, a in (("n_windows", "needed"), ("n_templates", "needed_templates"))]
    counts = counts.select(F.col("item_id").alias("id_"), F.col("item_key").alias("key_"), *needed)
    every = every.join(counts, F.col("item_id").eqNullSafe(F.col("id_")) & (F.col("item_key") == F.col("key_"))).drop("id_", "key_", "item_key")
    h = F.xxhash64("length", _hashes("tokens"))
    return every.select(F.array_join("tokens", " ").alias("key"), h.alias("h"), *[c for c in every.columns if c != "tokens"])


def _met(found: DataFrame, own: DataFrame, small: bool) -> DataFrame:
    """Windows of the texts beside those of items with their hash; strings are cut from these alone, or from all before a shuffle."""
    ids = ["doc_id", "text_key"]

    def cut(rows):
        # Exploded values: as a plain one, the key's comparison would become a key of the join, and a string be made of every window;
        # plain tokens would be cut later, and each hit hold the whole block.
        key, tokens = (_part(F.col(c), F.col("at"), F.col("size")) for c in ("tokens", "literal"))
        window = F.explode(F.array(F.struct(F.array_join(key, " ").alias("doc_key"), tokens.alias("doc_tokens")))).alias("window")
        own_columns = [c for c in own.columns if c in rows.columns]
        return rows.select(*ids, "pos", "doc_h", window, *own_columns).select(*ids, "pos", "doc_h", "window.*", *own_columns)

    same = F.col("doc_h") == F.col("h")
    return cut(found.join(own, same)) if small else cut(found).join(own, same)


def _short_windows(texts: DataFrame, lengths: list) -> DataFrame:
    """Windows of the texts by their lengths; hashes are of tokens' hashes, so no window is a string.

    A form is left out in a block where it equals the one before. Hashes of a window are few expressions, each evaluated once: the stage stays compiled.
    ``at`` is a window's place in its block, ``pos`` that in the text.
    """
    columns = ["doc_id", "text_key", "n", "start", "literal", "tokens"]
    literal, named, opened = (F.col(f"w.{form}") for form in FORMS)
    tokens = F.array_compact(F.array(literal, F.when(named != literal, named), F.when(opened != _form("named"), opened)))
    found = blocks(texts, lengths[-1]).select(*columns[:4], literal.alias("literal"), F.explode(tokens).alias("tokens"))
    found = found.select(*columns, F.explode(F.array(_hashes("tokens"))).alias("hashes"))
    n, pos = F.size("hashes"), (F.col("start") + F.col("at")).alias("pos")

    def windows(length):
        rows = found.where(n >= length if length >= SHORTEST else F.col("n") == length)
        rows = rows.select(*columns, "hashes", F.explode(F.sequence(F.lit(0), F.least(n - length, F.lit(BLOCK - 1)))).alias("at"))
        h = F.xxhash64(F.lit(length), *[F.get("hashes", F.col("at") + i) for i in range(length)])  # like an array of them
        return rows.select(*columns, "at", pos, F.lit(length).alias("size"), h.alias("doc_h"))

    def sized():
        rows = found.select(*columns, "hashes", F.explode(F.array(*map(F.lit, lengths))).alias("size"))
        rows = rows.where((n >= F.col("size")) & ((F.col("size") >= SHORTEST) | (F.col("n") == F.col("size"))))
        rows = rows.select(*columns, "hashes", "size", F.explode(F.sequence(F.lit(0), F.least(n - F.col("size"), F.lit(BLOCK - 1)))).alias("at"))
        return rows.select(*columns, "at", pos, "size", F.xxhash64("size", F.slice("hashes", F.col("at") + 1, F.col("size"))).alias("doc_h"))

    return windows(lengths[0]) if len(lengths) == 1 else sized()


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, item_id, diagonal, n_windows`` of consistent passages that are long enough."""
    grams = stored(benchmark_windows(benchmark), "benchmark-windows")
    sizes = grams.groupBy("is_long").agg(F.sort_array(F.collect_set("length")).alias("lengths")).collect()
    sizes = {r.is_long: r.lengths for r in sizes}
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id long, text_key long, item_id long, diagonal int, n_windows int")
    own, small = broadcast_if_small(grams, max_rows=100_000, max_bytes=8 << 20)
    texts = forms(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), "doc_id", "text_key")
    hits = _met(_short_windows(texts, sizes[False]), own.where("not is_long"), small)
    if True in sizes:
        found = long_windows(blocks(texts, sizes[True][-1]), sizes[True][-1]).where(F.col("pos") < BLOCK)
        found = found.select("doc_id", "text_key", F.col("pos").alias("at"), (F.col("start") + F.col("pos")).alias("pos"), F.col("length").alias("size"),
                             F.col("w.literal").alias("literal"), _form("named").alias("tokens"))
        found = found.withColumn("doc_h", F.xxhash64("size", _hashes(_part(F.col("tokens"), F.col("at"), F.col("size")))))
        hits = hits.unionByName(_met(found, own.where("is_long"), small))
    pairs = F.transform("slots", lambda s: F.struct(s["value"].alias("ours"), F.get("doc_tokens", s["at"]).alias("theirs")))
    hits = hits.where("doc_key = key").withColumn("pairs", pairs)
    passage = ["doc_id", "text_key", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")]
    whole = hits.groupBy(*passage).agg(
        F.size(F.collect_set("pos")).alias("n_windows"), F.size(F.collect_set(F.when(F.col("is_template"), F.col("pos")))).alias("n_templates"),
        F.min("needed").alias("needed"), F.min("needed_templates").alias("needed_templates"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    templates = (F.col("needed_templates") > 0) & (F.col("n_templates") >= F.col("needed_templates"))
    enough = (F.col("n_windows") >= F.col("needed")) | templates
    consistent = F.size(F.array_distinct("pairs.ours")) == F.size("pairs")
    return whole.where(enough & consistent).select("doc_id", "text_key", "item_id", "diagonal", "n_windows")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, items, n_windows`` of the texts that hold a passage."""
    found = passages(docs, benchmark).groupBy("doc_id", "text_key", "item_id").agg(F.max("n_windows").alias("n_windows"))
    return found.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.sum("n_windows").alias("n_windows"))


def flagged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every row's ``doc_id, leaked, n_items, items, n_windows``."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"), "items", "n_windows")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_"))
    return rows.join(found, same, "left").select(
        "doc_id", F.col("items").isNotNull().alias("leaked"), F.coalesce(F.size("items"), F.lit(0)).alias("n_items"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
    )


def _oracle() -> str:
    """The same in SQL, token by token."""
    MARKS = PRIVATE
    NAME, OPENING, NUMBER, UNIT = MARKS
    raw = rf"""list_filter(regexp_extract_all(coalesce(translate(text, '{MARKS}', ''), ''), '[^\x20\x09-\x0D]+'), lambda t: regexp_matches(t, '[\p{{L}}\p{{N}}]'))"""
    slots = f"('{NAME}', '{NUMBER}', '{UNIT}')"
    return rf"""
WITH raw AS (
  SELECT doc_id AS id, false AS is_item, {raw} AS t FROM documents
  UNION ALL SELECT item_id, true, {raw} FROM benchmark),
counted AS (
  SELECT id, is_item, list_transform(t, lambda x:
    CASE WHEN regexp_matches(x, '^[^\p{{L}}]*$') OR regexp_matches(x, '(?s)^[^\p{{L}}\p{{N}}]*(?i:{NUMBER_WORDS})[^\p{{L}}\p{{N}}]*$')
    THEN '{NUMBER}' || regexp_replace(x, '^[^\p{{L}}\p{{N}}]*', '') ELSE x END) AS t FROM raw),
measured AS (
  SELECT id, is_item, list_transform(t, lambda x, i:
    CASE WHEN i > 1 AND t[i - 1][1] = '{NUMBER}' AND regexp_matches(x, '(?s)^(?i:{UNITS})([^\p{{L}}\p{{N}}].*)?$')
    THEN '{UNIT}' || x ELSE x END) AS t FROM counted),
typed AS (
  SELECT id, is_item, list_transform(t, lambda x, i:
    CASE WHEN x[1] IN {slots} OR NOT regexp_matches(x, '(?s)^[^\p{{L}}\p{{N}}]*\p{{Lu}}\p{{Ll}}+([^\p{{L}}\p{{N}}].*)?$') THEN x
    WHEN i > 1 AND regexp_matches(t[i - 1], '[\p{{Ll}}\p{{N}},]$') THEN '{NAME}' || x ELSE '{OPENING}' || x END) AS t FROM measured),
clean AS (SELECT id, is_item, list_transform(t, lambda x: regexp_replace(lower(x), '[^\p{{L}}\p{{N}}{MARKS}]+', '', 'g')) AS t FROM typed),
forms AS (
  SELECT id, is_item, len(t) AS n, list_transform(t, lambda x: translate(x, '{MARKS}', '')) AS literal,
    list_transform(t, lambda x: CASE WHEN x[1] IN {slots} THEN x[1] ELSE translate(x, '{OPENING}', '') END) AS named,
    list_transform(t, lambda x: CASE WHEN x[1] IN {slots} THEN x[1] WHEN x[1] = '{OPENING}' THEN '{NAME}' ELSE x END) AS opened
  FROM clean WHERE len(t) > 0),
items AS (SELECT DISTINCT ON (id, literal, named, opened) *, least({WINDOW}, n) AS size FROM forms WHERE is_item),
numbered AS (SELECT row_number() OVER () AS item, * FROM items),
short AS (SELECT *, unnest(range(0, n - size + 1)) AS pos, size AS length, false AS is_long FROM numbered),
reach AS (
  SELECT *, list_filter(list_filter(range(1, n + 1), lambda k: named[k] NOT IN {slots}), lambda k: k > pos)[{WINDOW - MOST_SLOTS}] - pos AS length
  FROM (SELECT *, unnest(range(0, n)) AS pos FROM numbered)),
windows AS (
  SELECT item, id, pos, length, is_long, literal, named, opened FROM short
  UNION ALL SELECT item, id, pos, length, true, literal, named, opened FROM reach WHERE length > {WINDOW}),
cut AS (
  SELECT item, id AS item_id, pos, length, is_long, literal[pos + 1:pos + length] AS literal, named[pos + 1:pos + length] AS named,
    opened[pos + 1:pos + length] AS opened FROM windows),
weighed AS (
  SELECT *, len(list_filter(named, lambda x: x IN {slots})) <= {MOST_SLOTS} AS few_named,
    len(list_filter(opened, lambda x: x IN {slots})) <= {MOST_SLOTS} AS few_opened FROM cut),
needs AS (
  SELECT item, least({NEEDED}, count(*) FILTER (NOT is_long)) AS needed, least({NEEDED}, count(*) FILTER (is_long OR few_named)) AS needed_templates
  FROM weighed GROUP BY item),
item_keys AS (
  SELECT item_id, pos, length, is_long, is_long OR few_named AS is_template, literal, opened, needed, needed_templates, unnest(
    CASE WHEN is_long THEN [array_to_string(named, ' ')] ELSE list_distinct([array_to_string(literal, ' '),
      CASE WHEN few_named THEN array_to_string(named, ' ') END, CASE WHEN few_opened THEN array_to_string(opened, ' ') END]) END) AS key
  FROM weighed JOIN needs USING (item)),
longest AS (SELECT coalesce(max(length) FILTER (is_long), 0) AS longest FROM item_keys),
doc_tokens AS (
  SELECT id AS doc_id, n, unnest(range(0, n)) AS pos, unnest(literal) AS literal, unnest(named) AS named, unnest(opened) AS opened FROM forms WHERE NOT is_item),
following AS (
  SELECT doc_id, n, pos, list(literal) OVER ahead AS literal, list(named) OVER ahead AS named, list(opened) OVER ahead AS opened FROM doc_tokens
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
doc_short AS (
  SELECT doc_id, pos, size AS length, false AS is_long, literal[1:size] AS literal, named[1:size] AS named, opened[1:size] AS opened
  FROM following, (SELECT DISTINCT length AS size FROM item_keys WHERE NOT is_long) AS s
  WHERE pos + size <= n AND (size >= {SHORTEST} OR n = size)),
doc_reach AS (
  SELECT *, list_filter(lits, lambda k: k > pos)[{WINDOW - MOST_SLOTS}] - pos AS length FROM (
    SELECT id AS doc_id, literal, named, longest, list_filter(range(1, n + 1), lambda k: named[k] NOT IN {slots}) AS lits,
      unnest(range(0, n)) AS pos FROM forms, longest WHERE NOT is_item AND longest > 0)),
doc_keys AS (
  SELECT doc_id, pos, length, is_long, literal AS theirs,
    unnest(list_distinct([array_to_string(literal, ' '), array_to_string(named, ' '), array_to_string(opened, ' ')])) AS key FROM doc_short
  UNION ALL SELECT doc_id, pos, length, true, literal[pos + 1:pos + length], array_to_string(named[pos + 1:pos + length], ' ')
  FROM doc_reach WHERE length > {WINDOW} AND length <= longest),
matched AS (
  SELECT d.doc_id, i.item_id, d.pos - i.pos AS diagonal, d.pos, d.length, i.is_template, i.needed, i.needed_templates, i.literal, i.opened, d.theirs
  FROM doc_keys AS d JOIN item_keys AS i ON d.key = i.key AND d.length = i.length AND d.is_long = i.is_long),
places AS (
  SELECT doc_id, item_id, diagonal, literal[k] AS a, theirs[k] AS b
  FROM (SELECT *, unnest(range(1, length + 1)) AS k FROM matched) WHERE opened[k] IN {slots}),
twisted AS (
  SELECT DISTINCT doc_id, item_id, diagonal FROM (SELECT doc_id, item_id, diagonal, a FROM places GROUP BY ALL HAVING count(DISTINCT b) > 1)),
passages AS (
  SELECT doc_id, item_id, diagonal, count(DISTINCT pos) AS n FROM matched ANTI JOIN twisted USING (doc_id, item_id, diagonal)
  GROUP BY ALL HAVING count(DISTINCT pos) >= min(needed)
    OR (min(needed_templates) > 0 AND count(DISTINCT pos) FILTER (is_template) >= min(needed_templates))),
leaks AS (SELECT doc_id, item_id, max(n) AS n FROM passages GROUP BY ALL)
SELECT d.doc_id, count(l.item_id) > 0 AS leaked, CAST(count(l.item_id) AS INTEGER) AS n_items,
  coalesce(string_agg(CAST(l.item_id AS VARCHAR), ',' ORDER BY l.item_id), '') AS items, CAST(coalesce(sum(l.n), 0) AS BIGINT) AS n_windows
FROM documents d LEFT JOIN leaks l ON l.doc_id = d.doc_id GROUP BY d.doc_id"""


ORACLE = _oracle()


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage; columns unchanged."""
    found = stored(leaks(docs, benchmark).select("doc_id", "text_key"), "leaks")
    found, _ = broadcast_if_small(found.select(F.lit("").alias("none_"), F.col("doc_id").alias("id_"), F.col("text_key").alias("key_")))
    whole = docs.select("doc_id", F.xxhash64("text").alias("text_key"), whole_row(docs))
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_"))
    return whole.join(found, same, "left_anti").select("whole.*")
