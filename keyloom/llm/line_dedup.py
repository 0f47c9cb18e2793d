"""Operator 7: line dedup by a segment-partition edit join, in DataFrame functions alone.

A line is cut into threshold + 1 segments, the threshold being that of its length. Whatever that many edits do to
it, one segment survives, shifted by few places, in a line of nearly the same length. So each line is indexed by
its segments, and probes the indexes of its own and the shorter lengths with the substrings that can face a
segment. Pairs that meet are compared by their numbers of common characters, of which an edit changes two by one
at most, and then verified by an edit distance whose band of 2 * threshold + 1 diagonals is a machine word. As
only the existence of an earlier near line is asked for, lines first meet the earliest ones under each key. Where
none of these is near, a line meets the others under its keys if few of them are still in question; under keys with
many such lines, as those of a common phrase, it meets only those with which it shares a rare finer piece."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

#: (characters, edits): lines from so many characters on, up to the next such number, are near others of at most
#: their length within so many edits. Shorter lines are compared for equality alone.
EDITS = ((10, 1), (20, 2))
#: Parts of a key's lines whose earliest ones are met: under every key, then under those with over FEW lines that no
#: earlier one is known to be near to. Such a line meets the rest of its key only where there are no more than FEW.
LEADERS, FEW = (8, 128), 64
#: Characters of a fine piece at least, and fine pieces of a line at most, step by step.
PIECE, FINEST = 4, (32, 256, 1 << 30)
#: Characters whose numbers in two lines are compared before the lines are; all others together are one more.
COUNTED = "etaoinsrhldcumfgpbvyw "
#: Rows in a part, at least, of a table that is kept: few rows are not dealt over many small files by each later shuffle.
PART_ROWS = 1 << 14
#: Bits of the bitmap of candidates a candidate, and of the bitmap at most, as a power of two (128 MB).
SPARSE, BITS = 16, 30


def _kept(df: DataFrame) -> DataFrame:
    """A checkpoint, in as few parts as its rows need. A table that needs at least half of its parts stays as it is dealt."""
    out = checkpointed(df)
    parts = max(1, -(-out.count() // PART_ROWS))
    return out.coalesce(parts) if 2 * parts <= out.rdd.getNumPartitions() else out


def _segment(length: str, i: int | str, parts: int | str) -> tuple[str, str]:
    """SQL of the first character (from 0) and the length of segment i of a line; the last ones are longer."""
    base, short = f"cast(({length}) div {parts} as int)", f"({parts} - cast(({length}) % {parts} as int))"
    return f"({i} * {base} + greatest(0, {i} - {short}))", f"({base} + if({i} >= {short}, 1, 0))"


def _moves(i: int, edits: int, longer: int) -> range:
    """How far segment i may have moved in a text that is so much longer: by at most the edits before it, and
    by at most those left after it."""
    return range(max(-i, longer - (edits - i)), min(i, longer + edits - i) + 1)


def _ways(edits: int) -> list[tuple[int, int, int]]:
    """(less, segment, move) of a line's substrings that can face a segment of a line that is `less` shorter. The
    first ones, where nothing is less or moved, are its own segments, under which it is indexed too."""
    own = [(0, i, 0) for i in range(edits + 1)]
    return own + [w for less in range(edits + 1) for i in range(edits + 1) for move in _moves(i, edits, less) if (w := (less, i, move)) not in own]


def _key(edits: int, less: int, i: int, move: int) -> str:
    """SQL of the key: a hash of the threshold, the shorter line's length, the segment's number and characters."""
    at, n = _segment(f"chars - {less}", i, edits + 1)
    return f"if({at} + {move} >= 0, xxhash64({edits}, chars - {less}, {i}, substring(line, {at} + {move} + 1, {n})), null)"


def _spans(edits) -> list[tuple[int, int, int]]:
    """(edits, from, to) of the classes of lengths, in characters; the last one has no end."""
    return [(e, low, high) for (low, e), (high, _) in zip(edits, [*edits[1:], (1 << 31, 0)], strict=True)]


def _threshold(chars: str, edits) -> str:
    """SQL of the threshold of a line of so many characters."""
    return "case " + " ".join(f"when {chars} >= {low} and {chars} < {high} then {e}" for e, low, high in _spans(edits)) + " else 0 end"


def edit_distance(a: str, b: str, threshold: int) -> Column:
    """Edit distance of columns a and b where it is at most the threshold, otherwise some larger number.

    Bit k of a word stands for the diagonal k - threshold; the words of vertical and horizontal differences
    move down the diagonals, a character of the shorter line at a time."""
    width = 2 * threshold + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    pad = f"array_repeat('', {threshold})"
    longer, shorter = f"if(char_length({a}) >= char_length({b}), {a}, {b})", f"if(char_length({a}) >= char_length({b}), {b}, {a})"
    equal = " + ".join(f"if(get(c.l, i + {k}) = get(c.s, i), {1 << k}L, 0L)" for k in range(width))
    d0 = f"((((((x & z.vp) + z.vp) ^ z.vp) | x) | z.vn) & {full}L)"
    hp, hn = f"((z.vn | ~({d0} | z.vp)) & {full}L)", f"({d0} & z.vp)"
    turn = f"(n - {threshold})"  # from here on the last row is inside the band
    bit = f"shiftright({top >> 1}L, cast(z.i - greatest(0, {turn}) as int))"
    step = f"""case when z.d > {3 * threshold} then z else named_struct(
        'vp', ({hn} | ~(shiftright({d0}, 1) | {hp})) & {full}L,
        'vn', shiftright({d0}, 1) & {hp},
        'd', z.d + case when z.i < {turn} then if(({d0} & {top}L) = 0, 1, 0)
             else if(({hp} & {bit}) <> 0, 1, 0) - if(({hn} & {bit}) <> 0, 1, 0) end,
        'i', z.i + 1) end"""
    start = f"named_struct('vp', {(full << threshold) & full}L, 'vn', 0L, 'd', {threshold}, 'i', 0)"
    # nested one-element arrays stand for local names: c.l, c.s (characters), n (length of the longer line)
    walk = f"aggregate(transform(sequence(0, size(c.s) - 1), i -> {equal}), {start}, (z, x) -> {step}, z -> z.d)"
    inner = f"transform(array(size(c.l) - {2 * threshold}), n -> {walk})[0]"
    chars_l = f"concat({pad}, split({longer}, ''), {pad})"
    whole = f"transform(array(named_struct('l', {chars_l}, 's', split({shorter}, ''))), c -> {inner})[0]"
    far = f"abs(char_length({a}) - char_length({b})) > {threshold}"
    # within the threshold, stretches of equal length at the same place differ by at most twice as much
    ends = " or ".join(f"levenshtein({side}({a}, 24), {side}({b}, 24), {2 * threshold}) < 0" for side in ("left", "right"))
    inside = f"exists(sequence(0, cast(char_length({a}) div 48 as int)), k -> levenshtein(substring({a}, 48 * k + 1, 48), substring({b}, 48 * k + 1, 48), {2 * threshold}) < 0)"
    tiny = f"least(char_length({a}), char_length({b})) <= {threshold}"  # shorter than the band is wide
    return F.expr(f"case when {far} then {threshold + 1} when {tiny} then levenshtein({a}, {b}) when {ends} or {inside} then {threshold + 1} else {whole} end")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tie, pos, line, h, g) of every line that is not empty; tie is a hash of the text, h and g are hashes of
    the line, pos counts from 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), F.posexplode(F.split(text, "\n")).alias("pos", "line")).filter("line <> ''")
    return rows.withColumns({"h": F.xxhash64("line"), "g": F.xxhash64(F.lit("g"), F.col("line"))})


def _shared_keys(lines: DataFrame, edits) -> DataFrame:
    """(key, h, own, n): the entries of all keys under which different lines meet, one of them at least by a segment
    of its own; n: so many of a key. Equal lines are combined before anything is shuffled by key."""
    spans, most = _spans(edits), max(e for _, e in edits)
    width = max(len(_ways(e)) for e, _, _ in spans)
    keys = {f"k{j}": "case " + " ".join(f"when chars >= {low} and chars < {high} then {_key(e, *_ways(e)[j])}" for e, low, high in spans if j < len(_ways(e))) + " end" for j in range(width)}
    # lines a little too short for a class are indexed in it, for its lines to find
    keys |= {f"s{i}": "case " + " ".join(f"when chars >= {low - e} and chars < {low} then {_key(e, 0, i, 0)}" for e, low, _ in spans if i <= e) + " end" for i in range(most + 1)}
    long = lines.select("line", "h", "g", F.char_length("line").alias("chars")).filter(f"chars >= {min(low - e for e, low, _ in spans)}")
    distinct = long.groupBy("h", "g", "chars").agg(*[F.min(F.expr(sql)).alias(name) for name, sql in keys.items()])  # equal lines have equal keys
    entries = F.inline(F.array(*[F.struct(F.col(name).alias("key"), F.lit(1000 if name[0] == "s" else int(name[1:])).alias("way")) for name in keys]))
    entries = distinct.select("h", "chars", entries).filter("key is not null").select("key", "h", F.expr(f"way >= 1000 or way <= {_threshold('chars', edits)}").alias("own")).repartition("key")
    shared = entries.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.max("own").alias("any"), F.count("*").alias("n")).filter("low < high and any").select("key", "n")
    return entries.join(shared.hint("shuffle_hash"), "key")


def _marked(lines: DataFrame, wanted: DataFrame, h: str) -> DataFrame:
    """The rows whose hash h is in `wanted`, by a bitmap that is broadcast: SPARSE bits a wanted hash, 2**BITS bits
    at most; what passes is joined exactly."""
    bits = min(BITS, max(15, (SPARSE * wanted.count()).bit_length()))
    slot = F.expr(f"pmod({h}, {1 << bits}L) + 1")
    marks = wanted.select(slot.alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("marks"))
    met = lines.withColumn("slot", slot).withColumn("bucket", F.expr("bitmap_bucket_number(slot)")).join(F.broadcast(marks), "bucket")
    byte = "cast(conv(hex(substring(marks, cast(bitmap_bit_position(slot) div 8 as int) + 1, 1)), 16, 10) as int)"
    return met.filter(f"({byte} & shiftleft(1, cast(bitmap_bit_position(slot) % 8 as int))) <> 0").drop("bucket", "marks", "slot").join(wanted.hint("shuffle_hash"), h)


def _counts(line: str) -> str:
    """SQL of how many other characters than those of COUNTED the line has, and how many of each of these."""
    plain = f"translate({line}, '{COUNTED}', '')"
    return f"array(char_length({plain}), " + ", ".join(f"char_length({line}) - char_length(replace({line}, '{c}', ''))" for c in COUNTED) + ")"


def _l1(a: str, b: str) -> str:
    """SQL of how far the counts differ; an edit changes two of them by one at most."""
    return " + ".join(f"abs(get({a}, {k}) - get({b}, {k}))" for k in range(len(COUNTED) + 1))


def _met(later: DataFrame, early: DataFrame, most: int) -> DataFrame:
    """(h, g, eh, eg): the pairs under a key whose numbers of characters allow so many edits, the earlier line as e."""
    early = early.select("key", *[F.col(c).alias(f"e{c}") for c in ("first", "h", "g", "own", "counts")])
    return later.join(early, "key").filter(f"efirst < first and (own or eown) and {_l1('counts', 'ecounts')} <= {2 * most}").select("h", "g", "eh", "eg").distinct()


def _found(met: DataFrame, texts: DataFrame, edits) -> DataFrame:
    """(h, g) of the pairs that are near."""
    for h, g, line in (("h", "g", "line"), ("eh", "eg", "other")):
        met = met.join(texts.select(F.col("h").alias(h), F.col("g").alias(g), F.col("line").alias(line)), [h, g])
    longer = _threshold("greatest(char_length(line), char_length(other))", edits)
    return met.filter(edit_distance("line", "other", max(e for _, e in edits)) <= F.expr(longer)).select("h", "g").distinct()


def _pieces(chars: str, edits: int, finest: int) -> str:
    """SQL of the number of fine pieces of a line of so many characters."""
    return f"cast(greatest({edits + 1}, ({chars}) div greatest({PIECE}, ({chars}) div {finest})) as int)"


def _fine_keys(chars: str, edits: int, finest: int, move: int) -> str:
    """SQL of the keys of all fine pieces of a line of `chars` characters, looked for so many places further on."""
    m = _pieces(chars, edits, finest)
    at, n = _segment(chars, "i", m)
    key = f"if({at} + {move} >= 0, xxhash64('fine', {edits}, {chars}, {m}, i, substring(line, {at} + {move} + 1, {n})), null)"
    return f"transform(sequence(0, {m} - 1), i -> {key})"


def _exploded(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(h, g, key): nothing else of a line goes with each of its pieces."""
    return rows.select("h", "g", F.explode(F.expr(f"flatten(array({', '.join(keys)}))")).alias("key")).filter("key is not null")


def _crowded(lines: DataFrame, edits) -> DataFrame:
    """(h, g, eh, eg): pairs of lines that share segments with very many others. lines: h, g, first, line, counts,
    own (indexed by a segment that many share), open (no near line is known yet).

    A line is cut into ever finer pieces, many more than its threshold. Whatever the edits, one of any threshold + 1
    of them survives, so it is indexed by those alone that fewest lines have, and others look for all of theirs. A
    line that has no such rare ones is cut finer; at the finest, all that meet are compared."""
    spans, most = _spans(edits), max(e for _, e in edits)
    rows = _kept(lines.withColumn("chars", F.char_length("line")))
    facts = rows.select("h", "g", "first", "counts", "open")
    waiting, pairs = rows.filter("own"), None
    for step, finest in enumerate(FINEST):
        parts = [_exploded(waiting.filter(f"chars >= {low - e} and chars < {high}"), [_fine_keys("chars", e, finest, 0)]).withColumn("edits", F.lit(e)) for e, low, high in spans]
        rare = Window.partitionBy("h", "g", "edits").orderBy("having", "key")
        ranked = reduce(DataFrame.union, parts).withColumn("having", F.count("*").over(Window.partitionBy("key"))).withColumn("rank", F.row_number().over(rare))
        index = _kept(ranked.filter("rank <= edits + 1").select("key", "h", "g"))
        probes = []
        for e, low, high in spans:
            moves = [(less, move) for less in range(e + 1) for move in range(-e, e + 1) if abs(move) + abs(less - move) <= e]
            probes.append(_exploded(rows.filter(f"chars >= {low} and chars < {high}"), [_fine_keys(f"(chars - {less})", e, finest, move) for less, move in moves]))
        asked = _kept(_marked(reduce(DataFrame.union, probes), index.select("key").distinct(), "key"))
        if step + 1 < len(FINEST):
            busy = index.groupBy("key").agg(F.count("*").alias("n")).join(asked.groupBy("key").agg(F.count("*").alias("m")), "key").filter(f"least(n, m) > {FEW}").select("key")
            late = _kept(index.join(busy, "key", "left_semi").select("h", "g").distinct())
            index = index.join(late, ["h", "g"], "left_anti")
            waiting = waiting.join(late, ["h", "g"], "left_semi")
        other = index.join(facts, ["h", "g"]).select("key", *[F.col(c).alias(f"e{c}") for c in ("first", "h", "g", "counts", "open")])
        met = asked.join(facts, ["h", "g"]).join(other, "key").filter(f"first <> efirst and if(efirst < first, open, eopen) and {_l1('counts', 'ecounts')} <= {2 * most}")
        pair = F.expr("if(efirst < first, struct(h, g, eh, eg), struct(eh as h, eg as g, h as eh, g as eg))")
        met = _kept(met.select(pair.alias("p")).select("p.*").distinct())
        pairs = met if pairs is None else pairs.union(met)
        if step + 1 < len(FINEST) and late.isEmpty():
            break
    return pairs.distinct()


def near_lines(lines: DataFrame, edits=EDITS) -> DataFrame:
    """(h, g) of the lines that a different one within the longer line's threshold comes before, by first places.
    lines: id, tie, pos (the place), line, h, g (hashes). edits: see EDITS."""
    if not edits:
        return lines.select("h", "g").limit(0)
    most = max(e for _, e in edits)
    alive = _kept(_shared_keys(lines, edits))
    chosen = _marked(lines, alive.select("h").distinct(), "h")
    distinct = chosen.groupBy("h", "g").agg(F.min(F.struct("id", "tie", "pos")).alias("first"), F.first("line").alias("line"))
    texts = _kept(distinct.withColumn("counts", F.expr(_counts("line"))))
    # equal hashes h of different lines part here, as g is in the rows from now on
    entries = _kept(alive.join(texts.drop("line"), "h"))
    near, open_, crowds = None, entries, None
    for parts in LEADERS:  # the earliest line of each part of a key, among those indexed and among all
        entry = F.struct("first", "h", "g", "own", "counts")
        many = entries if crowds is None else entries.join(crowds, "key", "left_semi")
        lead = many.groupBy("key", F.expr(f"pmod(h, {parts})")).agg(F.min(F.when(F.col("own"), entry)).alias("a"), F.min(entry).alias("b"))
        early = lead.select("key", F.explode(F.array("a", "b")).alias("e")).filter("e is not null").select("key", "e.*").distinct()
        found = _found(_met(open_, early, most), texts, edits)
        near = _kept(found if near is None else near.union(found))
        open_ = entries.join(near, ["h", "g"], "left_anti")
        crowds = _kept(open_.groupBy("key").agg(F.count("*").alias("n")).filter(f"n > {FEW}").select("key"))
        if crowds.isEmpty():
            return near.union(_found(_met(open_, entries, most), texts, edits))
    near = near.union(_found(_met(open_.join(crowds, "key", "left_anti"), entries, most), texts, edits))
    near = _kept(near.distinct())
    crowd = entries.join(crowds, "key", "left_semi").groupBy("h", "g").agg(F.max("own").alias("own"))
    known = near.withColumn("known", F.lit(True))
    rows = texts.join(crowd, ["h", "g"]).join(known, ["h", "g"], "left").withColumn("open", F.col("known").isNull()).drop("known")
    return near.union(_found(_crowded(rows, edits), texts, edits))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits=EDITS) -> DataFrame:
    """Lines to remove: (id, tie, pos, near), a row a line; tie is a hash of the text, pos counts from 0.

    near is false where an equal line comes earlier (by id, text hash, place), true where only different lines
    near it first come earlier. Empty lines are never removed; see EDITS for which lines are near others."""
    lines = _lines(docs, id_col, text_col)
    place = F.struct("id", "tie", "pos")
    narrow = lines.select("id", "tie", "pos", "h", "g")
    near = near_lines(lines, edits).withColumn("near", F.lit(True))
    firsts = narrow.groupBy("h", "g").agg(F.min(place).alias("first"), F.count("*").alias("n")).join(near, ["h", "g"], "left").filter("n > 1 or near")
    found = narrow.join(firsts.hint("shuffle_hash"), ["h", "g"])
    here = place.eqNullSafe(F.col("first"))
    return found.filter(~here | F.col("near")).select("id", "tie", "pos", here.alias("near"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits=EDITS) -> DataFrame:
    """Per row: id, tie (a hash of the text), n_lines, n_exact and n_near (lines removed), removed (their places,
    ascending).

    The first of equal lines stays, unless a different line near it (see EDITS) comes before it; that line need
    not itself stay. Lines end at line feeds and may be of any length; a null or empty text is one empty line and
    loses nothing. Rows of equal id and text share their decisions, so that repeated rows stay as they are; null
    ids come first. An empty table gives an empty result."""
    gone = repeated_lines(docs, id_col, text_col, edits).distinct().groupBy("id", "tie").agg(F.count_if(~F.col("near")).alias("n_exact"), F.count_if("near").alias("n_near"), F.sort_array(F.collect_list("pos")).alias("removed"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), F.size(F.split(text, "\n")).cast("bigint").alias("n_lines"))
    gone = gone.withColumnRenamed("id", "i").withColumnRenamed("tie", "t")
    out = rows.join(gone, F.col("id").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t")), "left")
    return out.select(F.col("id").alias(id_col), "tie", "n_lines", F.coalesce("n_exact", F.lit(0)).cast("bigint").alias("n_exact"), F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits=EDITS) -> DataFrame:
    """The rows with their other columns, their texts without the lines that dedup_lines removes (possibly empty).
    Texts that lose nothing stay as they are, null ones too."""
    gone = repeated_lines(docs, id_col, text_col, edits).groupBy(F.col("id").alias("gone_id"), F.col("tie").alias("gone_tie")).agg(F.collect_set("pos").alias("gone_at"))
    tie = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("own_id"), tie.alias("own_tie"))
    met = rows.join(gone.hint("shuffle_hash"), F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_tie") == F.col("gone_tie")), "left")
    lines = met.withColumn("parts", F.split(F.col(f"row.`{text_col}`"), "\n"))
    left = F.expr("array_join(transform(array_except(sequence(0, size(parts) - 1), gone_at), i -> get(parts, i)), '\\n')")
    text = F.when(F.col("gone_at").isNull(), F.col(f"row.`{text_col}`")).otherwise(left)
    return lines.select(*[(text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
