"""Benchmark decontamination: template windows with typed slots, joined by hash.

Numbers, names and units of a text become typed placeholders. A window of the template is joined
to the windows of benchmark items; then the words behind the placeholders of a document and an
item must map to each other consistently. So a question whose names and numbers were exchanged is
still found. All of it is Spark expressions.

A text has several templates, the ways to match it; see ``templates``. One way suffices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import whole_text

#: Words of a window, literal words that it must hold, share of an item's windows that must
#: occur, and share of the slots that must agree with one mapping.
WINDOW, LITERALS, SHARE, AGREE = 8, 4, 0.5, 0.8
#: The ways to match, the first that matches is reported.
WAYS = ("typed", "joined", "lower", "exact")
#: How far the windows of one alignment may lie apart, in the joined and lower ways.
NEAR = 4
#: Rows up to which windows of the benchmark and digests are broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 500_000
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg lb lbs pound pounds ounce "
    "ounces ton tons ml cl l liter liters litre litres gallon gallons second seconds minute minutes "
    "hour hours day days week weeks month months year years percent degree degrees dollar dollars "
    "cent cents euro euros meter meters metre metres kilometer kilometers kilogram kilograms gram grams"
).split()
_DIGIT = "(ascii({0}) BETWEEN 48 AND 57)"


def _words() -> Column:
    """Runs of letters and digits; marks between two digits are left out first."""
    bare = F.regexp_replace(whole_text(), r"([0-9])[.,:](?=[0-9])", "$1")
    return F.filter(F.split(bare, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def templates(texts: DataFrame, *ids: str) -> DataFrame:
    """The id columns, ``words`` (letters and digits only) and a template for each way.

    typed: A token that starts with a digit is a number, one that starts with a capital is a name,
    and a unit's name after a number is a unit; any other token stands for itself in lower case.
    joined: Neighbouring names are one name, and a number and its unit are one number.
    lower: Only numbers have types, their units included, so capitals make no difference.
    exact: The words in lower case.

    ``joined_at`` and ``lower_at`` have the place of the first word of each token of these ways.
    """
    units = ", ".join(f"'{u}'" for u in UNITS)
    typed = f"""transform(words, (w, i) ->
        CASE WHEN {_DIGIT.format('w')} THEN '#number'
             WHEN substring(exact[i], 1, 1) != substring(w, 1, 1) THEN '#name'
             WHEN i > 0 AND w IN ({units}) AND {_DIGIT.format('words[i - 1]')} THEN '#unit'
             ELSE exact[i] END)"""
    joined_at = """filter(sequence(0, size(typed) - 1), i -> typed[i] != '#unit'
        AND NOT (i > 0 AND typed[i] = '#name' AND typed[greatest(i - 1, 0)] = '#name'))"""
    lower_at = f"""filter(sequence(0, size(exact) - 1), i ->
        NOT (i > 0 AND exact[i] IN ({units}) AND {_DIGIT.format('exact[greatest(i - 1, 0)]')}))"""
    lower = f"transform(lower_at, i -> CASE WHEN {_DIGIT.format('exact[i]')} THEN '#number' ELSE exact[i] END)"
    return (
        texts.select(*ids, _words().alias("words"))
        .where(F.size("words") >= LITERALS)
        .withColumn("exact", F.expr("transform(words, w -> lower(w))"))
        .withColumns({"typed": F.expr(typed), "lower_at": F.expr(lower_at)})
        .withColumns({"joined_at": F.expr(joined_at), "lower": F.expr(lower)})
        .withColumn("joined", F.expr("transform(joined_at, i -> typed[i])"))
    )


def _code(way: str, length: int) -> str:
    """What tells the windows of one way and length from all others: a number that starts their hash."""
    return f"{1000 * WAYS.index(way) + length}"


def _hashes(texts: DataFrame, *ids: str) -> DataFrame:
    """The id columns and for each way the hashes of the tokens of its template.

    The tokens are those of ``templates``, but their text is hashed once, and the ways are made of the
    hashes. Words are compared by their first byte where that decides.
    """
    units = ", ".join(f"'{u}'" for u in UNITS)
    number, name, unit = (f"xxhash64('{x}')" for x in ("#number", "#name", "#unit"))
    digit = "({0} >= '0' AND {0} < ':')"
    typed = f"""transform(words, (w, i) ->
        CASE WHEN {digit.format('w')} THEN {number}
             WHEN w >= 'a' AND w < '{{' THEN
               CASE WHEN i > 0 AND {digit.format('get(words, i - 1)')} AND w IN ({units}) THEN {unit}
                    ELSE get(exact, i) END
             WHEN substring(w, 1, 1) != lower(substring(w, 1, 1)) THEN {name}
             ELSE get(exact, i) END)"""
    counted = f"transform(words, (w, i) -> CASE WHEN {digit.format('w')} THEN {number} ELSE get(exact, i) END)"
    joined = f"""filter(typed, (x, i) ->
        x != {unit} AND NOT (i > 0 AND x = {name} AND get(typed, i - 1) = {name}))"""
    lower = f"""filter(counted, (x, i) ->
        NOT (i > 0 AND get(counted, i - 1) = {number} AND lower(get(words, i)) IN ({units})))"""
    return (
        texts.select(*ids, _words().alias("words"))
        .selectExpr(*ids, "words", "transform(words, w -> xxhash64(lower(w))) AS exact")
        .selectExpr(*ids, "words", "exact", f"{typed} AS typed", f"{counted} AS counted")
        .selectExpr(*ids, "exact", "typed", f"{joined} AS joined", f"{lower} AS lower")
    )


def _windows(of: DataFrame, ids: list[str], lengths: list[tuple[str, int]]) -> DataFrame:
    """Ids, place and hash of every window of the given ways and lengths.

    The ways' tokens are one array, of which each token is a row; a row's windows are hashed from it
    and the tokens after it, up to the end of its way. Only arrays of numbers are sliced into rows.
    """
    ways = [way for way in WAYS if way in {way for way, _ in lengths}]
    ends = [" + ".join(f"size({way})" for way in ways[: k + 1]) for k in range(len(ways))]
    named = ", ".join(f"'{way}', {end}" for way, end in zip(ways, ends))
    tokens = of.selectExpr(*ids, f"concat({', '.join(ways)}) AS tokens", f"named_struct({named}) AS ends")
    # The outer form: the inner one has Spark put a filter on the array's size below the projections,
    # where it makes the arrays again, and those within functions once for each token.
    rows = tokens.selectExpr(*ids, "tokens", "ends", "posexplode_outer(tokens) AS (at, token)")
    after = {"first": "0", "last": f"ends.{ways[-1]}", "code": f"{WAYS.index(ways[-1])}"}
    for k in reversed(range(len(ways) - 1)):
        inside = f"CASE WHEN at < ends.{ways[k]} THEN "
        after["code"] = f"{inside}{WAYS.index(ways[k])} ELSE {after['code']} END"
        after["last"] = f"{inside}ends.{ways[k]} ELSE {after['last']} END"
    for way in ways[:-1]:
        after["first"] = f"CASE WHEN at >= ends.{way} THEN ends.{way} ELSE {after['first']} END"
    placed = rows.selectExpr(
        *ids, "tokens", "at", "token", f"{after['code']} AS code", f"{after['last']} AS last", f"at - ({after['first']}) AS place"
    )
    hashes = []
    for n in sorted({n for _, n in lengths}):
        having = ", ".join(str(WAYS.index(way)) for way, m in lengths if m == n)
        following = "".join(f", get(tokens, at + {k})" for k in range(1, n))
        hashes.append(
            f"CASE WHEN at + {n} <= last AND code IN ({having}) "
            f"THEN xxhash64(1000 * code + {n}, token{following}) END"
        )
    if len(hashes) == 1:
        return placed.selectExpr(*ids, "place", f"{hashes[0]} AS hash")
    return placed.selectExpr(*ids, "place", f"explode(array({', '.join(hashes)})) AS hash")


def item_windows(items: DataFrame, window: int, literals: int = LITERALS) -> DataFrame:
    """item, way, place, length, hash of the windows that hold enough literal words, and n_windows.

    An item shorter than the window is one window. An item that has no such window however its
    words are written, as it consists of numbers, has all windows of its words.
    """
    rows = {}
    for way in WAYS:
        lengths = f"least(size({way}), {window})"
        sliced = items.selectExpr(
            "item",
            f"posexplode(transform(sequence(0, size({way}) - {lengths}), "
            f"i -> slice({way}, i + 1, {lengths}))) AS (place, part)",
        )
        literal = "size(filter(part, x -> NOT startswith(x, '#')))"
        hashed = " ".join(
            f"WHEN {n} THEN xxhash64({_code(way, n)}, "
            + ", ".join(f"xxhash64(get(part, {k}))" for k in range(n)) + ")"
            for n in range(max(literals, 1), window + 1)
        )
        rows[way] = sliced.where(f"{literal} >= {literals}").selectExpr(
            "item", f"'{way}' AS way", "place", "size(part) AS length",
            f"CASE size(part) {hashed} END AS hash",
        )
    rows["exact"] = rows["exact"].join(rows["lower"].select("item").distinct(), "item", "left_anti")
    every = reduce(DataFrame.unionByName, rows.values())
    counts = every.groupBy("item", "way").agg(F.countDistinct("hash").alias("n_windows"))
    return every.join(counts, ["item", "way"])


def find_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, share: float = SHARE,
    agree: float = AGREE, literals: int = LITERALS, near: int = NEAR,
) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_windows, n_found, n_slots,
    n_mapped, n_agree, digest.

    A document is contaminated by an item when at least ``share`` of the item's distinct template
    windows of ``window`` tokens (``literals`` of them literal words) occur in it in one alignment,
    and at least ``agree`` of the slots of that alignment
    follow one mapping of the item's words to the document's (``n_mapped``); two words of the item
    may become the same word. ``n_agree`` are the slots that follow one mapping each way. The alignment with most
    windows counts, then the smallest. Windows and slots are those of the first way that matches:
    names, numbers and units exchanged, for one with as many words or else for any; else numbers
    and units exchanged and capitals ignored. But in the first way, the windows of one alignment
    may be ``near`` words apart, so a few more or fewer words between them make no difference.

    Null or empty text matches nothing, in either table; items with fewer than ``literals`` words cannot
    be matched, those of numbers only word by word. Items that share an id are one item; items of null
    id are one for each text, with a null item_id. Null and repeated document ids: a row for each row of docs,
    as texts are judged by their digest. Empty tables: no rows. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "decontamination")
    key = "coalesce(concat('i', CAST(item_id AS STRING)), concat('n', md5(CAST(text AS BINARY))))"
    named = benchmark.where("text IS NOT NULL").selectExpr(f"{key} AS item", "item_id", "text").distinct()
    items = scratch.store(templates(named, "item", "item_id"), "items")
    wanted = scratch.store(item_windows(items, window, literals), "item-windows")
    lengths = sorted(tuple(r) for r in wanted.select("way", "length").distinct().collect())
    lengths = lengths or [("typed", window)]
    text = whole_text()
    texts = docs.select("doc_id", F.md5(text.cast("binary")).alias("digest"), text.alias("text"))
    target = _small(wanted.selectExpr("item", "way", "hash", "n_windows", "place AS item_place"))
    found = _windows(_hashes(texts, "digest"), ["digest"], lengths).join(target, "hash")
    shifted = found.withColumn("real", F.col("place") - F.col("item_place")).withColumn(
        "shift",
        F.expr(
            "explode(CASE WHEN way IN ('joined', 'lower') "
            f"THEN sequence(real - {near}, real + {near}) ELSE array(real) END)"
        ),
    )
    covering = "CASE WHEN way IN ('joined', 'lower') THEN struct(abs(real - shift), real, item_place) END"
    aligned = scratch.store(
        shifted.groupBy("digest", "item", "way", "n_windows", "shift")
        .agg(
            F.countDistinct("hash").alias("n_found"),
            F.max(F.expr("real = shift")).alias("met"),
            F.array_sort(F.collect_set(F.expr(covering))).alias("covering"),
        )
        .where(F.col("met") & (F.col("n_found") >= share * F.col("n_windows")))
        .drop("met"),
        "alignments",
    )
    judged = _consistent(texts, items, aligned, agree, window)
    ids = items.select("item", "item_id").distinct()
    judged = _small(scratch.store(judged.join(ids, "item").drop("item"), "judged"))
    return texts.select("doc_id", "digest").join(judged, "digest").select(
        "doc_id", "item_id", "n_windows", "n_found", "n_slots", "n_mapped", "n_agree", "digest"
    )


def _small(rows: DataFrame) -> DataFrame:
    """Stored rows, to be broadcast up to the limit; beyond, the side that a hash join builds."""
    few = rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(rows) if few else rows.hint("shuffle_hash")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of docs without a benchmark item, with all their columns."""
    found = find_contaminated(docs, benchmark, **options)
    scratch = Scratch(docs.sparkSession, "contaminated")
    found = _small(scratch.store(found.select(F.col("digest").alias("__found")).distinct(), "digests"))
    marked = docs.withColumn("__digest", F.md5(whole_text().cast("binary")))
    rows = marked.join(found, F.col("__digest") == F.col("__found"), "left_anti")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def _consistent(
    texts: DataFrame, items: DataFrame, aligned: DataFrame, agree: float, window: int
) -> DataFrame:
    """The best alignment of each text and item whose slots follow one mapping."""
    chosen = texts.join(_small(aligned.select("digest").distinct()), "digest", "left_semi")
    # One of equal texts; copies collapse in their tasks, before the exchange.
    once = chosen.groupBy("digest").agg(F.first("text").alias("text"))
    values = templates(once, "digest").select("digest", *_by_way("own"))
    asked = items.select("item", *_by_way("asked"))
    pairs = (
        aligned.join(values, "digest").join(asked, "item")
        .selectExpr(*aligned.columns, "own[way] AS own", "asked[way] AS asked")
    )
    # A slot's partner lies as far as the found window around it, or in the other ways the alignment.
    keys = [c for c in aligned.columns if c != "covering"]
    slots = pairs.selectExpr(
        *keys,
        f"""flatten(transform(filter(transform(transform(asked.kinds, (kind, i) -> named_struct('kind', kind,
             'asked', asked.words[i], 'at', i + CASE WHEN way IN ('joined', 'lower') THEN get(
               filter(covering, c -> c.item_place <= i AND i < c.item_place + {window}), 0).real
               ELSE shift END)),
             x -> named_struct('kind', x.kind, 'asked', x.asked,
             'given', CASE WHEN x.at >= 0 AND x.at < size(own.kinds) AND own.kinds[x.at] = x.kind
                           THEN own.words[x.at] END)),
           x -> startswith(x.kind, '#') AND x.given IS NOT NULL),
           x -> filter(array(
             named_struct('kind', x.kind, 'asked', substring_index(x.asked, ' ', 1),
                          'given', substring_index(x.given, ' ', 1)),
             named_struct('kind', '#unit', 'asked', substring(x.asked, nullif(instr(x.asked, ' '), 0)),
                          'given', substring(x.given, nullif(instr(x.given, ' '), 0)))),
             y -> y.asked IS NOT NULL AND y.given IS NOT NULL))) AS slots""",
    )
    exploded = slots.select(*keys, F.explode_outer("slots").alias("slot"))
    mapped = exploded.groupBy(*keys, "slot").agg(F.count("slot").alias("n"))
    # Of the words that one word maps to, the most frequent one is the mapping, either way; of
    # several, the one in the order of the words.
    place = f"row_number() OVER (PARTITION BY {', '.join(keys)}, slot.kind, slot.{{}} ORDER BY n DESC, slot)"
    top = mapped.selectExpr("*", f"{place.format('asked')} AS to_given", f"{place.format('given')} AS to_asked")
    judged = top.groupBy(*keys).agg(
        F.sum("n").alias("n_slots"),
        F.expr("sum(CASE WHEN to_given = 1 THEN n ELSE 0 END)").alias("n_mapped"),
        F.expr("sum(CASE WHEN to_given = 1 AND to_asked = 1 THEN n ELSE 0 END)").alias("n_agree"),
    )
    rank = ", ".join(f"'{way}'" for way in WAYS)
    best = F.max_by(
        F.struct("n_windows", "n_found", "n_slots", "n_mapped", "n_agree"),
        F.struct(-F.expr(f"array_position(array({rank}), way)"), "n_found", -F.col("shift")),
    ).alias("best")
    return (
        judged.where(F.col("n_mapped") >= agree * F.col("n_slots"))
        .groupBy("digest", "item")
        .agg(best)
        .select("digest", "item", "best.*")
    )


def _by_way(name: str) -> list[Column]:
    """A map from the way to the kinds of its tokens and their words in lower case.

    A number's unit, attached or not, follows after a blank where it is no token of its own.
    """
    words = {way: "exact" for way in WAYS}
    for way in ("joined", "lower"):
        until = f"coalesce(get({way}_at, j + 1), size(exact))"
        words[way] = f"""transform({way}_at, (i, j) -> regexp_replace(
            array_join(slice(exact, i + 1, {until} - i), ''), '^([0-9]+)({'|'.join(UNITS)})$', '$1 $2'))"""
    entries = ", ".join(f"'{way}', named_struct('kinds', {way}, 'words', {words[way]})" for way in WAYS)
    return [F.expr(f"map({entries})").alias(name)]
