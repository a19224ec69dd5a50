"""Removal of repeated and nearly repeated lines, in DataFrame functions only.

The edits t that a pair may differ by grow with the shorter line: one for each
MIN_CHARS characters, up to a threshold.  Lines within t edits share one of
t + 1 segments of the shorter one.  Segments are indexed by length and number;
a line probes the index of its own and of slightly smaller lengths with the
substrings that an alignment of at most t edits allows.  Lines that meet in a
segment and share the letters of one of 2t + 1 blocks are told apart by bits of
their letters and letter pairs; the rest is verified by the banded bit-parallel
edit distance on what lies between their common first and last words.

Only 64-bit hashes of segments and lines are shuffled; the texts of lines that
share a segment are fetched through a Bloom filter of bounded size.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlens.llm.bloom_cascade import BITS_PER_KEY, MAX_FILTER_BYTES, BloomFilter
from alertlens.llm.common import WORD, materialize, renamed, restored

#: most edits between two lines of any length
THRESHOLD = 2
#: code points of the shorter line for each edit; lines of fewer have none
MIN_CHARS = 24
LAST = 0x7FFFFFFFFFFFFFFF
LAST_PLACE = 0x7FFFFFFF


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b).cast("int")


def _segment(length: Column, i: Column, parts: Column) -> tuple[Column, Column]:
    """(first place from 0, length) of segment i; the last ones take what is left over."""
    short, over = _div(length, parts), length % parts
    return short * i + F.greatest(F.lit(0), over - (parts - i)), short + (over > parts - 1 - i).cast("int")


def edits_allowed(size: Column, threshold: int) -> Column:
    """The edits by which a line may differ from a longer one."""
    return F.least(_div(size, F.lit(MIN_CHARS)), F.lit(threshold))


def segment_entries(lines: DataFrame, threshold: int) -> DataFrame:
    """(key, a, role): a line's segments, and the substrings with which it probes the index of its own and smaller lengths.

    `role` is the number of edits of the indexed length, negative in entries that only probe.
    Segments and shifts are constant lists by the edits allowed, and places follow
    from them: generated code that spelt out every place is too long to be compiled.
    """
    size, t, delta, i, shift = (F.col(c) for c in ("size", "t", "delta", "i", "shift"))
    empty = F.array().cast("array<struct<t:int,delta:int,i:int,shift:int>>")
    lists = []
    for d in range(threshold + 1):
        chosen = empty
        for k in range(max(1, d), threshold + 1):
            shifts = lambda n: range(max(-n, d - (k - n)), min(n, d + (k - n)) + 1)  # noqa: E731, B023
            found = [F.struct(*[F.lit(v).alias(c) for v, c in zip((k, d, n, m), ("t", "delta", "i", "shift"))]) for n in range(k + 1) for m in shifts(n)]
            chosen = F.when(edits_allowed(size - d, threshold) == k, F.array(*found)).otherwise(chosen)
        lists.append(chosen)
    first, length = _segment(size - delta, i, t + 1)
    placed = (lines.withColumn("raw", F.encode("line", "UTF-32"))
              .select("a", "size", "raw", F.explode(F.concat(*lists)).alias("e")).select("a", "size", "raw", "e.*")
              .withColumn("length", length).withColumn("at", first + shift).filter((F.col("at") >= 0) & (F.col("at") + F.col("length") <= size)))
    # four bytes a code point: a piece is cut without counting through the line
    piece = F.substring(F.col("raw"), F.col("at") * 4 + 1, F.col("length") * 4)
    return placed.select(F.xxhash64("i", (size - delta).alias("own"), piece).alias("key"), "a",
                         F.when((delta == 0) & (shift == 0), t).otherwise(-t).alias("role"))


def shared_entries(lines: DataFrame, threshold: int) -> DataFrame:
    """The entries of the lines, each given once, whose key is indexed and held by another line too."""
    same = Window.partitionBy("key")
    return (segment_entries(lines, threshold)
            .withColumn("low", F.min("a").over(same)).withColumn("high", F.max("a").over(same)).withColumn("top", F.max("role").over(same))
            .filter((F.col("low") != F.col("high")) & (F.col("top") > 0)).select("key", "a", "role"))


def distinct_lines(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """(a, line, size) of each line once; only lines that may be repeated, by a filter of bounded size, are shuffled."""
    n, narrow = repeated.count(), lines.select("a", "line", "size")
    if n * BITS_PER_KEY // 8 > MAX_FILTER_BYTES:
        return narrow.distinct()
    again = BloomFilter(repeated, n, 0).passes(F.col("a")) if n else F.lit(False)
    return narrow.filter(~again).unionByName(narrow.filter(again).distinct())


def letter_marks(texts: DataFrame, threshold: int) -> DataFrame:
    """(a, letters, odd, low, high) of rows (a, b, line): sums that tell the letters of each block, 64 bits of the letters, 128 of the letter pairs.

    Letters are dealt to 2t + 1 blocks; an edit changes the letters of two blocks
    at most, so t edits leave one as it was.  A bit is the parity of the letters, or
    pairs of neighbours, that hash to it; an edit turns two, or four, at most.
    """
    blocks = 2 * threshold + 1
    at = F.col("bit")
    letters = F.array_remove(F.split("line", ""), "")
    one = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place)  # a shift takes the lowest six bits
    turned = one(at)
    return (texts.withColumn("c", letters).withColumn("d", F.slice("c", 2, F.lit(LAST_PLACE)))
            .select("a", "b", F.explode(F.arrays_zip("c", "d")).alias("p"))
            # 40 bits a letter: a sum of 8 million does not overflow
            .withColumn("weight", F.xxhash64("p.c").bitwiseAND(F.lit((1 << 40) - 1))).withColumn("block", F.ascii("p.c") % blocks)
            .withColumn("bit", F.when(F.col("p.d").isNotNull(), F.hash("p.c", "p.d").bitwiseAND(F.lit(127))))
            .groupBy("a", "b")
            .agg(F.array(*[F.sum(F.when(F.col("block") == j, F.col("weight")).otherwise(0)) for j in range(blocks)]).alias("letters"),
                 F.bit_xor(one(F.ascii("p.c"))).alias("odd"), F.bit_xor(F.when(at < 64, turned).otherwise(0)).alias("low"), F.bit_xor(F.when(at >= 64, turned).otherwise(0)).alias("high"))
            .select("a", "letters", "odd", "low", "high"))


def candidate_pairs(shared: DataFrame, marks: DataFrame, threshold: int) -> DataFrame:
    """(a1, a2): lines that share a segment where an alignment allows it, and the letters of a block."""
    entries = (shared.join(marks.withColumnRenamed("a", "m_a"), F.col("a") == F.col("m_a"))
               .select("key", "a", "role", "letters", "odd", "low", "high", F.posexplode("letters").alias("block", "held")))
    index = entries.filter("role > 0").select(*[F.col(c).alias(f"i_{c}") for c in entries.columns])
    once = (F.col("role") < 0) | (F.col("i_a") < F.col("a"))
    letters = F.bit_count(F.col("odd").bitwiseXOR(F.col("i_odd")))
    neighbours = F.bit_count(F.col("low").bitwiseXOR(F.col("i_low"))) + F.bit_count(F.col("high").bitwiseXOR(F.col("i_high")))
    # a pair comes from the first block whose letters it shares
    earlier = F.lit(False)
    for j in range(2 * threshold):
        earlier = earlier | ((F.col("block") > j) & (F.col("letters")[j] == F.col("i_letters")[j]))
    return (entries.join(index, (F.col("key") == F.col("i_key")) & (F.col("block") == F.col("i_block")) & (F.col("held") == F.col("i_held"))
                         & (F.col("a") != F.col("i_a")) & once & (letters <= 2 * F.col("i_role")) & (neighbours <= 4 * F.col("i_role")) & ~earlier)
            .select(F.least("i_a", "a").alias("a1"), F.greatest("i_a", "a").alias("a2")).distinct())


def banded_distance(x: Column, y: Column, threshold: int) -> Column:
    """Edit distance of two arrays of characters if at most the threshold, else more than it.

    A band of 2t+1 cells along the diagonal is one integer of vertical
    differences; a column of the table is a few bit operations on it.
    """
    ahead = F.array_repeat(F.lit("\n"), threshold)  # no line holds it; lets every band begin inside
    both_sides = F.array(F.struct(F.concat(ahead, x).alias("xs"), F.concat(ahead, y).alias("ys"), F.size(x).alias("turn")))
    # bound once, as a lambda computes what it names at every step
    return F.transform(both_sides, lambda s: _band(s["xs"], s["ys"], s["turn"], threshold))[0]


def _band(xs: Column, ys: Column, turn: Column, threshold: int) -> Column:
    """The distance of two arrays that begin with the same `threshold` symbols; turn: size of the first one without them."""
    width = 2 * threshold + 1
    mask = (1 << width) - 1
    lit = lambda v: F.lit(v).cast("int")
    both, either = lambda a, b: a.bitwiseAND(b), lambda a, b: a.bitwiseOR(b)
    flip = lambda a: a.bitwiseXOR(lit(mask))
    bit = lambda a, at: both(a, at).cast("boolean").cast("int")

    def step(acc: Column, symbol: Column) -> Column:
        j, vp, vn = acc["j"], acc["vp"], acc["vn"]
        match = lit(0)
        for b in range(width):
            at = j - threshold + b
            match = match + F.when((at >= 0) & (F.get(xs, F.greatest(at, F.lit(0))) == symbol), lit(1 << b)).otherwise(lit(0))
        carried = F.transform(F.array(F.struct(match.alias("m"), j.alias("j"), vp.alias("vp"), vn.alias("vn"), acc["d"].alias("d"))), inner)
        return carried[0]

    def inner(s: Column) -> Column:
        pm, vp, vn = s["m"], s["vp"], s["vn"]
        d0 = both(either(either((both(pm, vp) + vp).bitwiseXOR(vp), pm), vn), lit(mask))
        return F.transform(F.array(F.struct(d0.alias("d0"), s["j"].alias("j"), vp.alias("vp"), vn.alias("vn"), s["d"].alias("d"))), deeper)[0]

    def deeper(s: Column) -> Column:
        d0, vp, vn, j = s["d0"], s["vp"], s["vn"], s["j"]
        hp, hn = either(vn, flip(either(d0, vp))), both(d0, vp)
        down = F.shiftright(d0, 1)
        # after the turn the last row is followed: its bit moves right with every column
        place = F.greatest(turn - 1 + width - 1 - j, F.lit(0))
        at = F.element_at(F.array(*[lit(1 << b) for b in range(width)]), F.least(place, F.lit(width - 1)) + 1)
        change = F.when(j < turn, 1 - bit(d0, lit(1 << (width - 1)))).otherwise(bit(hp, at) - bit(hn, at))
        return F.struct((j + 1).alias("j"), either(hn, flip(either(down, hp))).alias("vp"), both(down, hp).alias("vn"), (s["d"] + change).alias("d"))

    start = F.struct(lit(0).alias("j"), lit((mask >> threshold) << threshold & mask).alias("vp"), lit(0).alias("vn"), lit(threshold).alias("d"))
    return F.aggregate(ys, start, step)["d"]


def _leading(a: Column, b: Column) -> Column:
    """Number of equal elements at the front of two arrays."""
    at = F.array_position(F.zip_with(a, b, lambda u, v: u.eqNullSafe(v)), F.lit(False))
    return F.when(at == 0, F.size(a)).otherwise(at - 1).cast("int")


def verified(pairs: DataFrame, threshold: int) -> DataFrame:
    """The rows of pairs (x, y, ...) of different lines whose distance is at most what the shorter one allows."""
    kept = pairs.columns
    middle = lambda words: F.slice(words, F.col("v_lead") + 1, F.size(words) - F.col("v_lead") - F.col("v_tail"))
    text = lambda words: F.array_remove(F.split(F.concat(F.array_join(words, " "), F.when(F.size(words) > 0, F.lit(" ")).otherwise(F.lit(""))), ""), "")
    # words that differ in place, apart by more spaces than an alignment can edit: such a distance is one of the lines too
    chars = lambda side: F.array_remove(F.split(F.array_join(F.transform("v_differ", lambda w: w[side]), " " * (threshold + 1)), ""), "")
    allowed = edits_allowed(F.least(F.length("x"), F.length("y")), threshold)
    in_place = F.size("v_p") == F.size("v_q")
    # characters of differing words that the other side's lack are as many edits of the lines
    strange = F.greatest(F.size(F.array_except("v_s", "v_t")), F.size(F.array_except("v_t", "v_s"))) > threshold
    found = (
        pairs.withColumn("v_a", F.split("x", " ")).withColumn("v_b", F.split("y", " "))
        .withColumn("v_lead", _leading(F.col("v_a"), F.col("v_b")))
        .withColumn("v_tail", F.least(_leading(F.reverse("v_a"), F.reverse("v_b")), F.least(F.size("v_a"), F.size("v_b")) - F.col("v_lead")))
        .withColumn("v_p", middle(F.col("v_a"))).withColumn("v_q", middle(F.col("v_b")))
        .withColumn("v_differ", F.when(in_place, F.filter(F.zip_with("v_p", "v_q", lambda u, v: F.struct(u.alias("p"), v.alias("q"))), lambda w: w["p"] != w["q"])))
        .withColumn("v_s", chars("p")).withColumn("v_t", chars("q"))
        .withColumn("v_near", (F.abs(F.length("x") - F.length("y")) <= threshold) & (F.size(F.array_except("v_p", "v_q")) <= 2 * threshold)
                    & (F.size(F.array_except("v_q", "v_p")) <= 2 * threshold) & ~(in_place & strange))
        .withColumn("v_few", F.when(F.col("v_near") & in_place, banded_distance(F.col("v_s"), F.col("v_t"), threshold)))
        .withColumn("v_d", F.when(~F.col("v_near"), threshold + 1).when(F.col("v_few") <= allowed, F.col("v_few"))
                    .otherwise(banded_distance(text(F.col("v_p")), text(F.col("v_q")), threshold)))
    )
    # generated, so that the filter is not pushed into, and repeats, the expressions above
    return (found.select(*kept, F.explode(F.array("v_d")).alias("v_d"))
            .filter(F.col("v_d") <= allowed).select(*kept))


def lines_of(docs: DataFrame, short: bool = False) -> DataFrame:
    """(doc, pos, line, size, a, b) of the lines that may go: those long enough, with `short` all that hold a word."""
    doc = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64("text").alias("h"))
    return (docs.select(doc.alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .withColumn("size", F.length("line")).filter(F.col("line").rlike(WORD) | (F.col("size") >= MIN_CHARS) if short else F.col("size") >= MIN_CHARS)
            .withColumn("a", F.xxhash64("line")).withColumn("b", F.xxhash64(F.lit(1), "line")))


def near_links(lines: DataFrame, repeated: DataFrame, threshold: int) -> DataFrame:
    """(a1, b1, a2, b2): different lines within the edits allowed, each pair once."""
    shared = materialize(shared_entries(distinct_lines(lines, repeated), threshold))
    wanted = shared.select(F.col("a").alias("key")).distinct()
    n = wanted.count()
    texts = lines.select("a", "b", "line")
    if n * BITS_PER_KEY // 8 <= MAX_FILTER_BYTES:
        texts = texts.filter(BloomFilter(wanted, n, 0).passes(F.col("a")) if n else F.lit(False))
    texts = materialize(texts.distinct())
    pairs = candidate_pairs(shared, letter_marks(texts, threshold), threshold)
    one = texts.select(F.col("a").alias("t1"), F.col("b").alias("b1"), F.col("line").alias("x"))
    two = texts.select(F.col("a").alias("t2"), F.col("b").alias("b2"), F.col("line").alias("y"))
    both = pairs.join(one, F.col("a1") == F.col("t1")).join(two, F.col("a2") == F.col("t2")).select("a1", "b1", "a2", "b2", "x", "y")
    return verified(both, threshold).select("a1", "b1", "a2", "b2")


def dropped_lines(docs: DataFrame, threshold: int = THRESHOLD, short: bool = False) -> DataFrame:
    """(doc, equal, near, links, dropped): for documents with links or dropped lines.

    equal and near count the dropped lines by cause, links the pairs that the
    document's lines form, dropped lists the line numbers from 0.
    """
    lines = lines_of(docs, short)
    spots = materialize(lines.select("doc", "pos", "a", "b"))
    first = spots.groupBy("a", "b").agg(F.min(F.struct("doc.id", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = first.filter("n > 1").select(F.col("a").alias("key")).distinct()
    links = materialize(near_links(lines.filter(F.col("size") >= MIN_CHARS), repeated, threshold))
    ends = links.unionByName(links.select(F.col("a2").alias("a1"), F.col("b2").alias("b1"), F.col("a1").alias("a2"), F.col("b1").alias("b2")))
    near = first.select(F.col("a").alias("n_a"), F.col("b").alias("n_b"), F.col("first").alias("n_first"))
    own = first.select(F.col("a").alias("o_a"), F.col("b").alias("o_b"), F.col("first").alias("o_first"))
    linked = (ends.join(near, (F.col("a2") == F.col("n_a")) & (F.col("b2") == F.col("n_b")))
              .join(own, (F.col("a1") == F.col("o_a")) & (F.col("b1") == F.col("o_b")))
              .groupBy(F.col("a1").alias("l_a"), F.col("b1").alias("l_b"))
              .agg(F.count(F.lit(1)).alias("links"), F.bool_or(F.col("n_first") < F.col("o_first")).alias("late")))
    told = (first.join(linked, (F.col("a") == F.col("l_a")) & (F.col("b") == F.col("l_b")), "left")
            .filter((F.col("n") > 1) | F.col("links").isNotNull())
            .select(F.col("a").alias("t_a"), F.col("b").alias("t_b"), "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("late", F.lit(False)).alias("late")))
    repeated = F.struct("doc.id", "pos") > F.col("first")
    return (spots.join(told, (F.col("a") == F.col("t_a")) & (F.col("b") == F.col("t_b")))
            .withColumn("repeated", repeated)
            .groupBy("doc").agg(F.sum(F.col("repeated").cast("long")).alias("equal"),
                                F.sum((F.col("late") & ~F.col("repeated")).cast("long")).alias("near"),
                                F.sum("links").alias("links"),
                                F.collect_set(F.when(F.col("repeated") | F.col("late"), F.col("pos"))).alias("dropped")))


def _told(docs: DataFrame, threshold: int, short: bool) -> DataFrame:
    """docs with the columns d_equal, d_near, d_links and d_dropped."""
    found = dropped_lines(docs, threshold, short).select("doc.id", "doc.h", *[F.col(c).alias(f"d_{c}") for c in ("equal", "near", "links", "dropped")])
    return docs.join(found, (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)) == F.col("id")) & (F.xxhash64("text") == F.col("h")), "left").drop("id", "h")


def line_report(docs: DataFrame, threshold: int = THRESHOLD, short: bool = False) -> DataFrame:
    """doc_id, n_lines, n_equal, n_near, n_links, dropped of every row of documents.

    A line goes if an earlier one, by document id and place, equals it or is
    within the edits allowed; lines are judged on the input.  The shorter of two
    lines allows one edit for each MIN_CHARS characters, up to the threshold.
    Lines of fewer have no edits; with `short`, as the query
    and the pipeline run it, their exact repeats go unless they are blank,
    otherwise they stay and count for nothing.

    Null text: no lines; empty text: one empty line.  Null ids come last.
    Rows that repeat an id and text are one document.  Empty input: no rows.
    Other input columns are not read.
    """
    rows = docs.select("doc_id", "text")
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    narrow = rows.select("doc_id", F.xxhash64("text").alias("r_h"), count.alias("n_lines"))
    found = dropped_lines(rows, threshold, short).select("doc.id", "doc.h", "equal", "near", "links", "dropped")
    zero = F.lit(0).cast("long")
    return (narrow.join(found, (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)) == F.col("id")) & (F.col("r_h") == F.col("h")), "left")
            .select("doc_id", "n_lines", F.coalesce("equal", zero).alias("n_equal"), F.coalesce("near", zero).alias("n_near"),
                    F.coalesce("links", zero).alias("n_links"), F.array_sort(F.coalesce("dropped", F.array().cast("array<int>"))).alias("dropped")))


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD, short: bool = False) -> DataFrame:
    """The rows of documents, their texts without the dropped lines and other columns, whatever their names, as they were."""
    rows, names = renamed(docs, "doc_id", "text")
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col("d_dropped"), i))
    text = F.when(F.size("d_dropped") > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    return _told(rows, threshold, short).select(*restored(names, text=text))
