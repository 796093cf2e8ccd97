"""Chat formatting by quotation linking, with DataFrame functions only.

A line's quote level is the number of ``>`` marks it begins with. Consecutive
quoted lines of one level are a passage. Passages are normalised to words (lower
case, letters and digits only), so wrapping does not matter, and hashed as a
whole and in aligned runs of 1, 2, 4 ... lines. A run is linked to the nearest
earlier message of the same conversation that holds its words in a row among its
own (level 0), at any place; messages that hold it as whole lines come first. A
line goes by the largest linked run it is in. A message replies to the message
most of its level-1 lines come from (ties: the later one; if it only quotes
deeper levels, the shallowest counts). Following replies up gives each message
its thread and depth, and ordering by (thread, depth, turn) puts a conversation
in reply order. The body keeps the message's own lines, without quotes and
without the attribution line that announces one.

Own words are looked at only in conversations with quotes: positions whose next
1, 2, 4 or 8 words begin a run are hashed at that run's length. Origins and
quotes of one hash meet by turn in slices of ``SLICE`` turns, whose last origins
are carried over, so no window or list spans a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import discard, materialize

MARKS = r"^[ \t]*(?:>[ \t]*)+"
MAX_ROUNDS = 64
ANCHORS = (8, 4, 2, 1)     # words that a run is first looked up by, as many as it has
SLICE = 12                 # turns that meet in one window, as a power of two


def level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def normalised(line: Column) -> Column:
    own = F.regexp_replace(line, MARKS, "")
    return F.trim(F.regexp_replace(F.lower(own), r"[^\p{L}\p{N}]+", " "))


def lines(messages: DataFrame) -> DataFrame:
    """(key, conv_id, turn, at, level, norm): the lines with a word of each message."""
    long = messages.select("key", "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return long.select("key", "conv_id", "turn", "at", level(F.col("line")).alias("level"), normalised(F.col("line")).alias("norm")).where("norm <> ''")


def body(text: Column) -> Column:
    """The text without quoted lines, attribution lines before them, and blank lines at its ends."""
    all_lines = F.split(text, "\n")
    marked = F.transform(all_lines, lambda x, i: F.struct(x.alias("line"), level(x).alias("level"),
                         level(F.coalesce(F.get(all_lines, i + 1), F.lit(""))).alias("next")))
    own = F.filter(marked, lambda x: (x["level"] == 0) & ~((x["next"] > 0) & x["line"].rlike(r"(?i)(wrote|writes|said|schrieb|escribió|a écrit)\s*:\s*$")))
    joined = F.array_join(F.transform(own, lambda x: x["line"]), "\n")
    return F.regexp_replace(joined, r"^\n+|\n+$", "")


def _runs(rows: DataFrame) -> DataFrame:
    """(key, conv_id, turn, level, block, j, run, at, words, m): the passages of each message
    in runs of 2 ** j lines, ``at`` the lines of a run."""
    quoting = rows.where("conv_id is not null and turn is not null").where(F.col("text").rlike("(?m)" + MARKS))
    raw = quoting.select("key", "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    raw = raw.select("key", "conv_id", "turn", "at", level(F.col("line")).alias("level"), normalised(F.col("line")).alias("norm"))
    raw = raw.withColumn("block", F.col("at") - F.row_number().over(Window.partitionBy("key", "level").orderBy("at")))
    quoted = raw.where("level > 0 and norm <> ''")
    block = Window.partitionBy("key", "level", "block")
    quoted = quoted.withColumn("i", F.row_number().over(block.orderBy("at")) - 1).withColumn("size", F.count("*").over(block))
    tall = quoted.withColumn("j", F.explode(F.sequence(F.lit(0), F.ceil(F.log2("size")).cast("int"))))
    of = F.array_sort(F.collect_list(F.struct("at", "norm")))
    runs = tall.groupBy("key", "conv_id", "turn", "level", "block", "j", F.floor(F.col("i") / F.pow(F.lit(2), F.col("j"))).alias("run")).agg(of.alias("of"))
    return runs.select("key", "conv_id", "turn", "level", "block", "j", "run", F.col("of.at").alias("at"),
                       F.split(F.array_join("of.norm", " "), " ").alias("words")).withColumn("m", F.size("words"))


def _hash(words: Column) -> Column:
    return F.xxhash64(F.array_join(words, " "))


def _held(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(conv_id, m, hash, turn, whole): messages whose own words hold a run of ``asked(conv_id, a, anchor, m, hash)``."""
    own = F.filter(F.split("text", "\n"), lambda x: level(x) == 0)
    own = F.filter(F.transform(own, normalised), lambda x: x != "")
    messages = (rows.where("turn is not null").join(asked.select("conv_id").distinct(), "conv_id", "left_semi")
                .select("key", "conv_id", "turn", own.alias("own")).where("size(own) > 0"))
    # The last word of a line ends in a line break in ``ends``. Written, as a lambda would compute a whole array for each element.
    messages = materialize(messages.select("key", "conv_id", "turn", F.split(F.array_join("own", " "), " ").alias("w"),
                                           F.split(F.concat(F.array_join("own", "\n "), F.lit("\n")), " ").alias("ends")), "own")
    grams = F.array(*(F.struct(F.lit(a).alias("a"), F.when(F.size("w") >= a, F.transform(F.sequence(F.lit(1), F.size("w") - (a - 1)),
                    lambda p: _hash(F.slice("w", p, a)))).alias("anchors")) for a in ANCHORS))
    places = (messages.select("key", "conv_id", F.size("w").alias("n"), F.inline(grams))
              .select("key", "conv_id", "n", "a", F.posexplode("anchors").alias("p", "anchor")))
    hits = places.join(asked.select("conv_id", "a", "anchor", "m").distinct(), ["conv_id", "a", "anchor"]).where("p + m <= n")
    hits = hits.groupBy("key").agg(F.collect_set(F.struct("p", "m")).alias("hits"))
    ends = lambda i: F.coalesce(F.get("ends", i).endswith("\n"), F.lit(True))
    found = messages.join(hits, "key").select("conv_id", "turn", F.inline(F.transform("hits", lambda x: F.struct(
        x["m"].alias("m"), _hash(F.slice("w", x["p"] + 1, x["m"])).alias("hash"),
        (ends(x["p"] - 1) & ends(x["p"] + x["m"] - 1)).alias("whole")))))
    return (found.join(asked.select("conv_id", "m", "hash").distinct(), ["conv_id", "m", "hash"], "left_semi")
            .groupBy("conv_id", "m", "hash", "turn").agg(F.max("whole").alias("whole")))


def _nearest(asked: DataFrame, held: DataFrame) -> DataFrame:
    """(conv_id, m, hash, turn, origin): the last turn of ``held`` before each turn of ``asked``, those that hold whole lines first."""
    by = ["conv_id", "m", "hash"]
    both = held.select(*by, "turn", F.col("turn").alias("any"), F.when(F.col("whole"), F.col("turn")).alias("whole"), F.lit(False).alias("asks")).unionByName(
        asked.select(*by, "turn", F.lit(None).cast("bigint").alias("any"), F.lit(None).cast("bigint").alias("whole"), F.lit(True).alias("asks")).distinct())
    both = both.withColumn("slice", F.shiftright("turn", SLICE))
    inside = Window.partitionBy(*by, "slice").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    near = both.select(*by, "slice", "turn", "asks", F.max("any").over(inside).alias("any"), F.max("whole").over(inside).alias("whole")).where("asks")
    carried = both.groupBy(*by, "slice").agg(F.max("any").alias("any"), F.max("whole").alias("whole"))
    carried = carried.select(*by, "slice", F.max("any").over(before).alias("any0"), F.max("whole").over(before).alias("whole0"))
    return near.join(carried, [*by, "slice"]).select(*by, "turn", F.coalesce("whole", "whole0", "any", "any0").alias("origin")).where("origin is not null")


def _linked_lines(rows: DataFrame) -> DataFrame:
    """(key, conv_id, turn, level, at, origin): quoted lines found in an earlier message."""
    runs = _runs(rows)
    a = F.coalesce(*(F.when(F.col("m") >= k, F.lit(k)) for k in ANCHORS))
    runs = runs.withColumn("a", a).withColumn("anchor", _hash(F.slice("words", 1, F.col("a")))).withColumn("hash", _hash(F.col("words"))).drop("words")
    runs = materialize(runs, "runs")
    origins = _nearest(runs, _held(rows, runs))
    return (runs.join(origins, ["conv_id", "m", "hash", "turn"]).select("key", "conv_id", "turn", "level", "j", "origin", F.explode("at").alias("at"))
            .groupBy("key", "conv_id", "turn", "level", "at").agg(F.max_by("origin", "j").alias("origin")))


def link_quotes(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> per row (conv_id, turn,
    role, n_lines, n_quoted, n_linked, max_level, reply_to, thread, depth, body).

    ``n_lines`` counts lines with a letter or digit, ``n_quoted`` those at level
    1 or more, ``n_linked`` those found in an earlier message. ``reply_to`` is a
    turn of the same conversation or null; ``thread`` is the turn that the
    replies lead up to, ``depth`` the steps. A null text has an empty body; a
    row with null conv_id or turn links to nothing and is its own thread. Rows
    that repeat (conv_id, turn) are formatted each and count as one message
    where others quote or follow them (its lowest reply). Other columns are not read.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = materialize(rows.withColumn("key", F.monotonically_increasing_id()), "messages")
    long = lines(rows)
    linked = _linked_lines(rows).groupBy("key", "conv_id", "turn", "level", "origin").agg(F.count("*").alias("n"))
    linked = materialize(linked, "linked")
    parent = linked.groupBy("key", "conv_id", "turn").agg(
        F.sum("n").alias("n_linked"), F.max_by("origin", F.struct(-F.col("level"), F.col("n"), F.col("origin"))).alias("reply_to"))
    counted = long.groupBy("key").agg(F.count("*").alias("n_lines"), F.count_if(F.col("level") > 0).alias("n_quoted"), F.max("level").alias("max_level"))

    # Follow replies up: each round doubles the steps taken.
    up = materialize(parent.groupBy("conv_id", "turn").agg(F.min("reply_to").alias("top")).withColumn("depth", F.lit(1).cast("bigint")), "up")
    for _ in range(MAX_ROUNDS):
        above = up.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more"))
        step = up.join(above, ["conv_id", "top"], "left")
        new = materialize(step.select("conv_id", "turn", F.coalesce("next", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                      F.col("next").isNotNull().alias("moved")), "up")
        discard(up)
        up, moved = new, not new.where("moved").isEmpty()
        if not moved:
            break
    else:
        raise RuntimeError("replies do not end")   # a reply goes to an earlier turn, so this can't happen
    out = (rows.join(counted, "key", "left").join(parent.select("key", "n_linked", "reply_to"), "key", "left")
           .join(up.select("conv_id", "turn", "top", "depth"), ["conv_id", "turn"], "left"))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select("conv_id", "turn", "role", number("n_lines"), number("n_quoted"), number("n_linked"), number("max_level"),
                      "reply_to", F.coalesce("top", "turn").alias("thread"), number("depth"), body(F.col("text")).alias("body"))


def quoting_replies(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` where turns quote an earlier one above their own text: whole, wrapped
    anew, only its first line, or that line at level 2. A table to try the linking on, from real messages, where a
    corpus quotes nothing itself; it has a row for each row with a conv_id and turn that do not repeat."""
    own = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    said = own.select("conv_id", F.col("turn").alias("of"), F.col("role").alias("by"), F.col("text").alias("said"))
    x = own.withColumn("of", F.col("turn") - 1 - F.col("turn") % 3).join(said, ["conv_id", "of"], "left")
    first = F.split_part("said", F.lit("\n"), F.lit(1))
    shown = (F.when(F.col("turn") % 4 == 0, F.col("said")).when(F.col("turn") % 4 == 1, F.regexp_replace("said", r"((?:[^ \n]+ ){6})", "$1\n"))
             .otherwise(first))
    mark = F.when(F.col("turn") % 4 == 3, ">> ").otherwise("> ")
    quoted = F.concat(mark, F.replace(shown, F.lit("\n"), F.concat(F.lit("\n"), mark)))
    return x.select("conv_id", "turn", "role", F.when(F.col("said").isNotNull(), F.concat("by", F.lit(" wrote:\n"), quoted, F.lit("\n\n"), "text"))
                    .otherwise(F.col("text")).alias("text"))


# In DuckDB: the nearest earlier message that holds a run, found by comparing texts instead of hashes;
# a recursive query follows the replies.
SQL = r"""
with recursive messages as (
  select row_number() over () as key, cast(conv_id as bigint) conv_id, cast(turn as bigint) turn, cast(role as varchar) as role, coalesce(text, '') as text
  from conversations),
raw as (
  select key, conv_id, turn, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from messages),
marked as (
  select *, length(regexp_extract(line, '^[ \t]*(?:>[ \t]*)+')) - length(replace(regexp_extract(line, '^[ \t]*(?:>[ \t]*)+'), '>', '')) as level from raw),
long as (
  select *, trim(regexp_replace(lower(regexp_replace(line, '^[ \t]*(?:>[ \t]*)+', '')), '[^\p{L}\p{N}]+', ' ', 'g')) as norm from marked),
placed as (
  select *, pos - row_number() over (partition by key, level order by pos) as block from long where conv_id is not null and turn is not null),
quoted as (
  select *, row_number() over (partition by key, level, block order by pos) - 1 as i, count(*) over (partition by key, level, block) as size
  from placed where level > 0 and norm <> ''),
tall as (select *, unnest(range(0, ceil(log2(size))::int + 1)) as j from quoted),
runs as (
  select key, conv_id, turn, level, block, j, floor(i / pow(2, j))::bigint as run, list(pos order by pos) as at, string_agg(norm, ' ' order by pos) as words
  from tall group by key, conv_id, turn, level, block, j, floor(i / pow(2, j))::bigint),
said as (select key, conv_id, turn, list(norm order by pos) as ls from long where level = 0 and norm <> '' and turn is not null group by key, conv_id, turn),
starts as (select *, unnest(range(1, len(ls) + 1)) as a from said),
pieces as (select conv_id, turn, ls, a, unnest(range(a, len(ls) + 1)) as b from starts),
whole_lines as (select distinct conv_id, turn, array_to_string(ls[a:b], ' ') as words from pieces),
whole as (
  select r.key, r.level, r.block, r.j, r.run, max(w.turn) as origin from runs r join whole_lines w on w.conv_id = r.conv_id and w.words = r.words and w.turn < r.turn group by all),
part as (
  select r.key, r.level, r.block, r.j, r.run, max(o.turn) as origin from runs r join said o on o.conv_id = r.conv_id and o.turn < r.turn
    and contains(' ' || array_to_string(o.ls, ' ') || ' ', ' ' || r.words || ' ') group by all),
origins as (
  select r.key, r.conv_id, r.turn, r.level, r.j, unnest(r.at) as pos, coalesce(w.origin, p.origin) as origin
  from runs r join part p using (key, level, block, j, run) left join whole w using (key, level, block, j, run)),
found as (select key, conv_id, turn, level, pos, arg_max(origin, j) as origin from origins group by all),
linked as (select key, conv_id, turn, level, origin, count(*) as n from found group by all),
parent as (
  select distinct on (key) key, conv_id, turn, origin as reply_to, sum(n) over (partition by key) as n_linked
  from linked order by key, level, n desc, origin desc),
link as (select conv_id, turn, min(reply_to) as top from parent group by all),
walk as (
  select conv_id, turn, top, 1 as depth from link
  union all select w.conv_id, w.turn, l.top, w.depth + 1 from walk w join link l on l.conv_id = w.conv_id and l.turn = w.top),
root as (select conv_id, turn, arg_max(top, depth) as top, max(depth) as depth from walk group by all),
counted as (
  select key, count(*) as n_lines, count(*) filter (where level > 0) as n_quoted, max(level) as max_level from long where norm <> '' group by all),
own as (
  select key, pos, line, level, lead(level, 1, 0) over (partition by key order by pos) as next from long),
bodies as (
  select key, regexp_replace(string_agg(line, chr(10) order by pos), '^\n+|\n+$', '', 'g') as body from own
  where level = 0 and not (next > 0 and regexp_matches(line, '(?i)(wrote|writes|said|schrieb|escribió|a écrit)\s*:\s*$')) group by all)
select m.conv_id, m.turn, m.role, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_quoted, 0) as bigint) as n_quoted,
  cast(coalesce(n_linked, 0) as bigint) as n_linked, cast(coalesce(max_level, 0) as bigint) as max_level, reply_to,
  coalesce(r.top, m.turn) as thread, cast(coalesce(r.depth, 0) as bigint) as depth, coalesce(body, '') as body
from messages m left join counted c on c.key = m.key left join parent p on p.key = m.key
left join root r on r.conv_id = m.conv_id and r.turn = m.turn left join bodies b on b.key = m.key
"""

_REPLIES = r"""
derived as (
  select c.conv_id, c.turn, c.role,
    case when s.conv_id is null then coalesce(c.text, '')
         else s.role || ' wrote:' || chr(10) || m.mark || replace(
           case when c.turn % 4 = 0 then coalesce(s.text, '') when c.turn % 4 = 1 then regexp_replace(coalesce(s.text, ''), '((?:[^ \n]+ ){6})', '\1' || chr(10), 'g')
                else split_part(coalesce(s.text, ''), chr(10), 1) end, chr(10), chr(10) || m.mark) || chr(10) || chr(10) || coalesce(c.text, '') end as text
  from (select *, case when turn % 4 = 3 then '>> ' else '> ' end as mark from conversations) m
  join conversations c on c.conv_id = m.conv_id and c.turn = m.turn
  left join conversations s on s.conv_id = c.conv_id and s.turn = c.turn - 1 - c.turn % 3),
"""
SQL_OF_REPLIES = SQL.replace("with recursive messages", "with recursive" + _REPLIES + "messages").replace("from conversations),", "from derived),")
