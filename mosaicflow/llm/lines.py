"""Line deduplication by a segment-partition edit join; DataFrame functions only.

Two lines are alike at edit distance 1 or less. A line is split into two segments, threshold plus one, of which one
edit leaves one whole; the other is split into two again, of which again one stays whole. So alike lines agree in all
but one quarter, and a line's keys are the hashes of what is left without each quarter, with the length and the
quarter's number in them. A line of length L indexes its own four keys and probes those of length L - 1, whose second
part then starts one character later. Lines of every length are indexed; a quarter of a very short line is empty.

Lines that meet at a key are candidates. They are verified by a banded bit-parallel edit distance, written with Spark's
array functions: one band of 2 x threshold + 1 bits moves along the diagonal, one character a step. Where more than HOT
lines have one key (numbered boilerplate), their pairs are not made: the quarter that the key leaves out is indexed
again, without each of its characters, and lines meet in groups of equal rests, where counts and minima are enough.
A link is taken at the first of the keys that its two lines share, so it counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stored, numbered, stored, table, unused

THRESHOLD, QUARTERS, HOT = 1, 4, 64
BITS = 26
#: A line of nothing else is blank.
BLANKS = " \t\x0b\f\r"
OWN = [f"own{i}" for i in range(QUARTERS)]
PROBE = [f"probe{i}" for i in range(QUARTERS)]


def bounds(base: Column, i: int | Column) -> tuple[Column, Column]:
    """Where the i-th quarter of a line of length base begins and ends."""
    return F.floor(base * i / QUARTERS).cast("int"), F.floor(base * (i + 1) / QUARTERS).cast("int")


def quarter(line: Column, base: Column, i: int, shift: int) -> Column:
    """Hash of the i-th quarter of a line of length base, moved by so many characters."""
    begin, end = bounds(base, i)
    return F.xxhash64(line.substr(begin + 1 + shift, end - begin))


def key(base: Column, i: int, rest: list[str]) -> Column:
    """A line without its i-th quarter, by the hashes of the others."""
    return F.xxhash64(base, F.lit(i), *[c for k, c in enumerate(rest) if k != i])


def not_blank(line: Column) -> Column:
    """A first character beyond white space tells at once; others are trimmed."""
    return (F.ascii(line) > 32) | (F.trim(line, F.lit(BLANKS)) != "")


def occurrences(docs: DataFrame) -> DataFrame:
    """rid, doc_id, line_no (from 0), h1, h2 (a 128-bit hash of the line) and its keys, for each line that is not blank.

    A row without lines gives one row without line_no, a blank line one without h1.
    """
    rows = docs.withColumn("rid", F.monotonically_increasing_id()).select("rid", "doc_id", F.posexplode_outer(F.split("text", "\n", -1)).alias("line_no", "line"))
    rows = rows.withColumn("size", F.char_length("line")).withColumn("seen", not_blank(F.col("line")))
    line, size, every = F.col("line"), F.col("size"), range(QUARTERS)
    # as the longer line: the quarters before the one that is left out stand where they do in the shorter line, those behind one further
    parts = {f"q{i}": quarter(line, size, i, 0) for i in every} | {f"l{i}": quarter(line, size - 1, i, 0) for i in every[:-1]} | {f"r{i}": quarter(line, size - 1, i, 1) for i in every[1:]}
    rows = rows.withColumns(parts)
    keys = [F.when(F.col("seen"), key(size, i, [f"q{k}" for k in every])).alias(n) for i, n in enumerate(OWN)]
    keys += [F.when(F.col("seen"), key(size - 1, i, [f"{'l' if k < i else 'r'}{k}" for k in every])).alias(n) for i, n in enumerate(PROBE)]
    return rows.select("rid", "doc_id", "line_no", F.when(F.col("seen"), F.xxhash64("line")).alias("h1"), F.when(F.col("seen"), F.xxhash64(F.lit(1), F.col("line"))).alias("h2"), *keys)


def entries(lines: DataFrame) -> DataFrame:
    """(h1, h2, k, i, longer): each line under its own keys and, as the longer one, under those that it probes."""
    of = lambda cols, longer: F.transform(F.array(*cols), lambda k, i: F.struct(k.alias("k"), i.cast("byte").alias("i"), F.lit(longer).alias("longer")))
    return lines.select("h1", "h2", F.explode(F.concat(of(OWN, False), of(PROBE, True))).alias("e")).select("h1", "h2", "e.k", "e.i", "e.longer")


def often_met(lines: DataFrame) -> DataFrame:
    """(k, hot): the keys that two lines or more have, at least one of them as its own. Counted before the shuffle."""
    often = entries(lines).groupBy("k").agg(F.count("*").alias("n"), F.count_if(~F.col("longer")).alias("own"))
    return often.filter("n > 1 and own > 0").select("k", (F.col("n") > HOT).alias("hot"))


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """h1, h2, line of the wanted lines. A bitmap of their hashes, 8 MB whatever their number, keeps others from the shuffle."""
    slot = F.pmod(F.col("h1"), F.lit(1 << BITS)) + 1
    bits = wanted.select(slot.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))
    rows = docs.select(F.explode(F.split("text", "\n", -1)).alias("line")).filter(not_blank(F.col("line")))
    rows = rows.select("line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")).withColumn("v", slot)
    near = rows.withColumn("bucket", F.bitmap_bucket_number("v")).withColumn("at", F.bitmap_bit_position("v")).join(F.broadcast(bits), "bucket")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    kept = near.withColumn("byte", byte).filter(F.expr("getbit(byte, cast(at % 8 as int)) = 1"))
    # stored, for the optimizer would move the join below the bitmap's filter and deal out all lines
    return stored(kept.select("h1", "h2", "line"), "lines-near").join(wanted, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.first("line").alias("line"))


def within(x: str, y: str, threshold: int) -> Column:
    """True where the edit distance of two text columns is threshold at most.

    The band holds the differences between neighbouring cells of the rows j - threshold to j + threshold of column j as
    two words of bits, up and down; the distance is followed along the band's last diagonal until that leaves the
    pattern, and then along the pattern's last row.
    """
    t, width = threshold, 2 * threshold + 1
    full = (1 << width) - 1
    same = " | ".join(f"if(get(v.x, j + {d - t}) = get(v.y, j), {1 << d}L, 0L)" for d in range(width))
    m, n = "v.m", "v.n"
    # eq: which rows of the band match; zero: where the diagonal does not rise; hp, hn: rising and falling along the row
    step = f"""
      aggregate(sequence(0, {n} - 1), named_struct('up', {full - (1 << t) + 1}L, 'down', 0L, 'far', least({t}, {m})), (s, j) ->
        aggregate(array(named_struct('eq', {same})), s, (s, e) ->
          aggregate(array(((((e.eq & s.up) + s.up) ^ s.up) | e.eq | s.down) & {full}L), s, (s, zero) ->
            aggregate(array(named_struct('hp', (s.down | ~(zero | s.up)) & {full}L, 'hn', zero & s.up)), s, (s, h) -> named_struct(
              'up', (h.hn | ~(shiftright(zero, 1) | h.hp)) & {full}L,
              'down', shiftright(zero, 1) & h.hp,
              'far', s.far + if(j < {m} - {t}, if((zero & {1 << (2 * t)}L) = 0, 1, 0),
                cast(shiftright(h.hp, {m} - 1 - j + {t}) & 1L as int) - cast(shiftright(h.hn, {m} - 1 - j + {t}) & 1L as int)))))),
        s -> s.far)"""
    # a lambda's variable is worked out once; a column of arrays would be split again at every use
    both = f"named_struct('x', split({x}, ''), 'y', split({y}, ''), 'm', char_length({x}), 'n', char_length({y}))"
    return F.expr(f"abs(char_length({x}) - char_length({y})) <= {t} and aggregate(array({both}), false, (r, v) -> if({n} = 0, {m}, if({m} = 0, {n}, {step})) <= {t})")


def pair_links(met: DataFrame, texts: DataFrame) -> DataFrame:
    """(h1, h2, o1, o2), both ways, of alike lines that meet at keys of at most HOT lines."""
    cold = met.filter(~F.col("hot"))
    left = cold.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), "k", "i", "longer")
    right = cold.filter(~F.col("longer")).select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), "k")
    first = (F.col("a1") < F.col("b1")) | ((F.col("a1") == F.col("b1")) & (F.col("a2") < F.col("b2")))
    pairs = left.join(right, "k").filter(F.col("longer") | first).groupBy("a1", "a2", "b1", "b2").agg(F.min("i").alias("i"))
    a = texts.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line").alias("x"))
    b = texts.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("y"))
    both = pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"])
    # a link whose lines also meet at an earlier, hot key is that key's
    size, base = F.char_length("x"), F.char_length("y")
    before = F.lit(False)
    for i in range(QUARTERS):
        begin, end = bounds(base, i)
        agree = (F.substring("x", F.lit(1), begin) == F.substring("y", F.lit(1), begin)) & (F.col("x").substr(size - (base - end) + 1, base - end) == F.col("y").substr(end + 1, base - end))
        before = before | ((F.col("i") > i) & agree)
    both = both.filter(~before).filter(within("x", "y", THRESHOLD))
    return both.select(F.col("a1").alias("h1"), F.col("a2").alias("h2"), F.col("b1").alias("o1"), F.col("b2").alias("o2"), "i").select(
        F.explode(F.array(F.struct("h1", "h2", "o1", "o2"), F.struct(F.col("o1").alias("h1"), F.col("o2").alias("h2"), F.col("h1").alias("o1"), F.col("h2").alias("o2")))).alias("p")
    ).select("p.*")


def group_links(met: DataFrame, texts: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h1, h2, other, links): of each line at a hot key how many lines are alike in what the key leaves out, and the
    earliest of them (or the line itself, where it is earlier).

    Equal lengths: the rest of the quarter without its p-th character is a group. Lengths that differ by one: the longer
    line's quarter without the first character of each run of equal ones is the shorter line's whole quarter. A run that
    begins where the quarter before ends belongs to that one.
    """
    rows = met.filter("hot").join(texts, ["h1", "h2"]).join(firsts, ["h1", "h2"])
    size = F.char_length("line")
    base = size - F.col("longer").cast("int")
    begin, end = bounds(base, F.col("i").cast("int"))
    part = F.col("line").substr(begin + 1, end - begin + F.col("longer").cast("int"))
    rows = rows.select("k", "i", "h1", "h2", "longer", "first", F.split(part, "").alias("q"), part.alias("part"))
    rows = rows.withColumn("q", F.when(F.col("part") == "", F.array().cast("array<string>")).otherwise(F.col("q")))
    without = lambda p: F.concat_ws("", F.slice("q", F.lit(1), p), F.slice("q", p + 2, F.size("q")))
    places = F.when(F.size("q") > 0, F.sequence(F.lit(0), F.size("q") - 1)).otherwise(F.array().cast("array<int>"))
    runs = F.filter(places, lambda p: F.when(p > 0, F.get("q", p) != F.get("q", p - 1)).otherwise(F.col("i") == 0))
    changed = F.transform(places, lambda p: F.struct(p.alias("p"), without(p).alias("rest")))
    shorter = F.transform(runs, lambda p: F.struct(F.lit(-1).alias("p"), without(p).alias("rest")))
    whole = F.array(F.struct(F.lit(-1).alias("p"), F.col("part").alias("rest")))
    groups = rows.select("k", "h1", "h2", "longer", "first", F.explode(F.when(F.col("longer"), shorter).otherwise(F.concat(whole, changed))).alias("g"))
    groups = groups.select("k", "h1", "h2", "longer", "first", F.col("g.p").alias("p"), F.xxhash64("g.rest").alias("r1"), F.xxhash64(F.lit(1), "g.rest").alias("r2"))
    groups = stored(groups, "lines-groups")
    by = ["k", "p", "r1", "r2"]
    found = groups.groupBy(*by).agg(F.count_if("longer").alias("n_longer"), F.count_if(~F.col("longer")).alias("n_own"), F.min("first").alias("lo"), F.min(F.when(F.col("longer"), F.col("first"))).alias("lo_longer"), F.min(F.when(~F.col("longer"), F.col("first"))).alias("lo_own"))
    found = found.filter("if(p < 0, n_longer > 0 and n_own > 0, n_own > 1)")
    pair = F.col("p") < 0
    n = F.when(pair, F.when(F.col("longer"), F.col("n_own")).otherwise(F.col("n_longer"))).otherwise(F.col("n_own") - 1)
    lo = F.when(pair, F.when(F.col("longer"), F.col("lo_own")).otherwise(F.col("lo_longer"))).otherwise(F.col("lo"))
    return groups.join(found, by).select("h1", "h2", lo.alias("other"), n.alias("links"))


def links(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(h1, h2, other, links): for lines that are alike to others, the earliest place of one of these, and their number."""
    entry = lines.select("h1", "h2", *OWN, *PROBE)
    often = stored(often_met(entry), "lines-often")
    met = stored(entries(entry).join(often, "k").select("k", "i", "h1", "h2", "longer", "hot"), "lines-met")
    wanted = stored(met.select("h1", "h2").distinct(), "lines-wanted")
    texts = stored(texts_of(docs, wanted), "lines-texts")
    firsts = lines.select("h1", "h2", "first")
    pairs = pair_links(met, texts).join(firsts.toDF("o1", "o2", "other"), ["o1", "o2"]).select("h1", "h2", "other", F.lit(1).cast("long").alias("links"))
    every = pairs.unionByName(group_links(met, texts, firsts))
    found = stored(every.groupBy("h1", "h2").agg(F.min("other").alias("other"), F.sum("links").alias("links")), "lines-links")
    drop_stored(often, met, wanted, texts)
    return found


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_repeats, n_removed, n_links, removed_lines of each row of docs (doc_id, text).

    A line that is not blank is removed if an equal or alike line stands before it: in a smaller (doc_id, row), or
    further up. n_repeats: of those, lines equal to an earlier one; n_links: pairs of this row's lines, first of their
    kind, with other alike lines; removed_lines: their numbers from 0, comma-joined. A null text has no lines, an
    empty one has one blank line; blank lines (of white space only) are never touched; null ids come before all others;
    repeated rows are rows of their own; other columns, whatever their names, are left out; an empty table gives no rows.
    """
    return report(docs.select("doc_id", F.col("text").cast("string").alias("text"))).drop("rid")


def report(docs: DataFrame) -> DataFrame:
    """line_report with rid, the row's number as monotonically_increasing_id gives it to the rows of docs."""
    every = stored(occurrences(docs), "lines-every")
    place = F.struct("doc_id", "rid", "line_no")
    firsts = every.filter("h1 is not null").groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"), *[F.first(k).alias(k) for k in OWN + PROBE])
    lines = stored(firsts, "lines-distinct")
    near = links(docs, lines)
    known = lines.select("h1", "h2", "first", "n").join(near, ["h1", "h2"], "left").filter("n > 1 or links is not null")
    known = stored(known.select("h1", "h2", "first", (F.col("other") < F.col("first")).alias("alike"), "links"), "lines-known")
    drop_stored(lines, near)
    marked = every.select("rid", "doc_id", "line_no", "h1", "h2").join(known, ["h1", "h2"], "left")
    repeat = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(place)
    gone = repeat | F.coalesce("alike", F.lit(False))
    one = lambda c: F.coalesce(F.sum(F.when(c, 1)), F.lit(0))
    return (
        marked.withColumn("repeat", F.coalesce(repeat, F.lit(False))).withColumn("gone", F.coalesce(gone, F.lit(False)))
        .groupBy("rid", "doc_id")
        .agg(
            F.count("line_no").alias("n_lines"), one(F.col("repeat")).alias("n_repeats"), one(F.col("gone")).alias("n_removed"),
            F.coalesce(F.sum(F.when(~F.col("repeat"), F.col("links"))), F.lit(0)).alias("n_links"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("gone"), F.col("line_no")))), lambda x: x.cast("string")), ",").alias("removed_lines"),
        )
    )


def drop_lines(docs: DataFrame) -> DataFrame:
    """docs without the lines that line_report removes, row by row, ids or none; all other columns stay as they are."""
    number, gone = unused(docs, "rid", "gone")
    own = numbered(docs, number)
    text = F.col("text").cast("string")
    # rows are told apart by their own number, whatever their ids
    told = report(own.select(F.struct("doc_id", number).alias("doc_id"), text.alias("text"))).filter("n_removed > 0")
    told = told.select(F.col(f"doc_id.{number}").alias(number), F.split("removed_lines", ",").cast("array<int>").alias(gone))
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains(gone, i)), "\n")
    out = own.join(told, number, "left")
    return out.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that repeat or nearly repeat earlier ones; see line_report for nulls, ties and empty tables."""
    return line_report(table(spark, sf_dir, "documents"))


#: The same by comparing all lines of near-equal length. DuckDB's levenshtein counts bytes, so it only prunes here.
OP1_SQL = r"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as line_no from documents where text is not null
), u as (
  select line, min({'d': doc_id, 'n': line_no}) as first, length(line) as size from l where regexp_matches(line, '[^\x09\x0B-\x0D\x20]') group by line
), p as (
  select a.line as a, b.line as b, b.first as other from u a join u b on a.size = b.size and a.line <> b.line
    where levenshtein(a.line, b.line) <= 4
      and len(list_filter(range(a.size), lambda i: substr(a.line, i + 1, 1) <> substr(b.line, i + 1, 1))) <= 1
  union all select a.line, b.line, b.first from u a join u b on a.size = b.size + 1
    where levenshtein(a.line, b.line) <= 4
      and len(list_filter(range(a.size), lambda i: substr(a.line, 1, i) || substr(a.line, i + 2) = b.line)) > 0
  union all select b.line, a.line, a.first from u a join u b on a.size = b.size + 1
    where levenshtein(a.line, b.line) <= 4
      and len(list_filter(range(a.size), lambda i: substr(a.line, 1, i) || substr(a.line, i + 2) = b.line)) > 0
), near as (select a, min(other) as other, count(*) as links from p group by a
), m as (
  select l.doc_id, l.line_no, u.first is not null and u.first <> {'d': l.doc_id, 'n': l.line_no} as repeat, coalesce(near.other < u.first, false) as alike, coalesce(links, 0) as links
  from l left join u on l.line = u.line left join near on l.line = near.a
)
select d.doc_id, count(m.line_no) as n_lines, cast(coalesce(sum(case when repeat then 1 end), 0) as bigint) as n_repeats,
  cast(coalesce(sum(case when repeat or alike then 1 end), 0) as bigint) as n_removed, cast(coalesce(sum(case when not repeat then links end), 0) as bigint) as n_links,
  coalesce(string_agg(case when repeat or alike then cast(m.line_no as varchar) end, ',' order by m.line_no), '') as removed_lines
from documents d left join m on d.doc_id = m.doc_id group by d.doc_id
"""
