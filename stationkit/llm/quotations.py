"""Quotation linking: conversations in reply order, without quotes.

Lines that begin with one or more ``>`` are quotes of that level. Consecutive
lines of one level are a passage, however they are wrapped. A quoted passage is
normalised and the hashes of its word shingles are joined to the messages before
it that hold them one level lower; the message that holds most of them is the one
quoted, and the message most is quoted from is the one replied to. Built-in
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationkit.plans.keyed import attach
from stationkit.plans.ordered import last_so_far, range_blocks
from stationkit.plans.stored import store

_MARK = r"^(\s*(?:>\s?)+)"
# Turns of a conversation that are looked at together when the turn before is sought.
_TURNS = 256
# Words of a shingle. Of a quote every STRIDE-th is looked up, and the last.
SHINGLE = 4
STRIDE = 4
# Words that the quoted form takes from an earlier message, and words on a quoted line.
_EXCERPT, _WRAP = 20, 8


def _previous_turns(keys: DataFrame) -> DataFrame:
    """Columns ``conv_id, turn, previous``; found by groups of turns, so that a long
    conversation is no single task."""
    grouped = keys.withColumn("part", F.floor(F.col("turn") / _TURNS))
    lasts = grouped.groupBy("conv_id", "part").agg(F.max("turn").alias("last"))
    before = Window.partitionBy("conv_id").orderBy("part")
    lasts = lasts.select("conv_id", "part", F.lag("last").over(before).alias("earlier"))
    inside = Window.partitionBy("conv_id", "part").orderBy("turn")
    rows = grouped.withColumn("lag", F.lag("turn").over(inside)).join(lasts, ["conv_id", "part"])
    return rows.select("conv_id", "turn", F.coalesce("lag", "earlier").alias("previous"))


def _plain(text: Column) -> Column:
    """Lower case, single spaces."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def passages(messages: DataFrame) -> DataFrame:
    """Columns ``conv_id, turn, row, passage, level, words``: runs of lines of one level.

    ``row`` tells apart rows that repeat a message. A blank line ends a passage,
    as does a line of another level. Words are in lower case.
    """
    # Numbered before they are cut into lines, not after.
    rows = messages.select("conv_id", "turn", "text", F.monotonically_increasing_id().alias("row"))
    lines = rows.select(
        "conv_id", "turn", "row", F.posexplode(F.split("text", "\n")).alias("line", "raw")
    )
    mark = F.regexp_extract("raw", _MARK, 1)
    leveled = lines.withColumn("mark", mark).select(
        "conv_id", "turn", "row", "line",
        F.length(F.regexp_replace("mark", "[^>]", "")).alias("level"),
        _plain(F.expr("substring(raw, length(mark) + 1)")).alias("plain"),
    )
    # The lines of one text only.
    text = Window.partitionBy("row").orderBy("line")
    goes_on = (F.lag("level").over(text) == F.col("level")) & (F.lag("plain").over(text) != "")
    begins = F.when(goes_on, 0).otherwise(1)
    numbered = leveled.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(text))
    return (
        numbered.where("plain != ''")
        .groupBy("conv_id", "turn", "row", "passage", "level")
        .agg(F.sort_array(F.collect_list(F.struct("line", "plain"))).alias("lines"))
        .withColumn("words", F.split(F.array_join("lines.plain", " "), " "))
        .drop("lines")
    )


def _shingles(words: Column, stride: int) -> Column:
    """Hashes of the word shingles, from every ``stride``-th place and the last; few words are one."""
    last = F.size(words) - (SHINGLE - 1)
    places = F.array_union(F.sequence(F.lit(1), last, F.lit(stride)), F.array(last))
    cut = F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(words, i, SHINGLE), " ")))
    return F.array_distinct(
        F.when(last >= 1, cut).otherwise(F.array(F.xxhash64(F.array_join(words, " "))))
    )


def linked_passages(messages: DataFrame) -> DataFrame:
    """Quoted passages with the turn they are quoted from.

    Columns ``conv_id, turn, row, passage, level, original, held``: ``held`` is
    the number of shingles found in turn ``original``, both null if no earlier
    message holds half of them. A shingle counts for the last message before the
    quote that holds it; of messages that hold equally many the later counts. A
    quote of fewer words than a shingle is found only where it was a passage of
    its own.
    """
    found = store(passages(messages), "passages").df
    key = ["conv_id", "level", "hash"]
    quotes = found.where("level > 0").select(
        "conv_id", "turn", "row", "passage", "level", F.explode(_shingles(F.col("words"), STRIDE)).alias("hash")
    )
    quotes = store(quotes, "quoted-shingles").df
    wanted = quotes.select(*key).distinct()
    holders = (
        found.select("conv_id", "turn", (F.col("level") + 1).alias("level"),
                     F.explode(_shingles(F.col("words"), 1)).alias("hash"))
        .distinct().join(wanted, key, "left_semi")
    )
    both = quotes.withColumn("side", F.lit(0)).unionByName(
        holders.withColumn("side", F.lit(1)), allowMissingColumns=True
    )
    # At the same turn the quote comes first: a message does not quote itself.
    order = [*key, "turn", "side", "row", "passage"]
    blocks = range_blocks(both, order, "quotes-and-holders")
    holder = F.when(F.col("side") == 1, F.struct(*key, "turn"))
    seen = last_so_far(blocks, order, holder, "last", "_block").where("side = 0")
    same = [F.col(k) == F.col(f"last.{k}") for k in key]
    # A holder of the same turn does not reach back behind a second row of that turn.
    original = F.when(same[0] & same[1] & same[2] & (F.col("last.turn") < F.col("turn")), F.col("last.turn"))
    one = ["conv_id", "turn", "row", "passage", "level"]
    votes = seen.groupBy(*one, original.alias("original")).agg(F.count(F.lit(1)).alias("held"))
    best = F.max(F.when(F.col("original").isNotNull(), F.struct("held", "original"))).alias("best")
    chosen = votes.groupBy(*one).agg(best, F.sum("held").alias("all"))
    enough = F.col("best.held") * 2 >= F.col("all")
    return chosen.select(
        *one, F.when(enough, F.col("best.original")).alias("original"),
        F.when(enough, F.col("best.held")).alias("held"),
    )


def with_quotes(messages: DataFrame) -> DataFrame:
    """The messages as mail would show them: three of four quote a part of an earlier turn, two deep.

    A hash of conversation and turn chooses one of the two turns before, and
    where the excerpt begins. Its words are wrapped anew and marked with ``>``;
    what the quoted message itself quotes comes above it, marked once more.
    """
    flat = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    rows = messages.withColumn("_flat", flat).withColumn(
        "_h", F.conv(F.substring(F.md5(F.concat_ws("/", "conv_id", "turn")), 1, 8), 16, 10).cast("bigint")
    )
    quoting = F.when(F.col("_h") % 4 != 0, F.col("turn") - 1 - F.col("_h") % 2).alias("_of")
    texts = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(
        F.min("_flat").alias("_text"), F.first("_h").alias("_h")
    )

    def excerpt(words: Column) -> Column:
        begin = F.floor(F.col("_h") / 8) % F.greatest(F.size(words) - _EXCERPT, F.lit(1))
        part = F.slice(words, begin.cast("int") + 1, _EXCERPT)
        lines = F.sequence(F.lit(1), F.size(part), F.lit(_WRAP))
        return F.transform(lines, lambda i: F.concat(F.lit("> "), F.array_join(F.slice(part, i, _WRAP), " ")))

    originals = store(texts.select("conv_id", F.col("turn").alias("_of"), F.col("_text").alias("_said")), "texts")
    quoted = attach(texts.select("conv_id", "turn", "_h", quoting), originals, ["conv_id", "_of"])
    own = F.when(F.col("_said") != "", excerpt(F.split("_said", " ")))
    cited = store(quoted.select("conv_id", "turn", own.alias("_cited"), "_of"), "cited")
    above = cited.view(cited.df.select("conv_id", F.col("turn").alias("_of"), F.col("_cited").alias("_above")))
    whole = store(attach(cited.df, above, ["conv_id", "_of"]).drop("_of"), "quoted")
    joined = attach(rows.drop("_flat", "_h"), whole, ["conv_id", "turn"])
    none = F.array().cast("array<string>")
    nested = F.transform(F.coalesce("_above", none), lambda line: F.concat(F.lit("> "), line))
    # Without a quote of its own a message shows none of another's.
    lines = F.when(
        F.col("_cited").isNotNull(), F.concat(nested, F.col("_cited"), F.array(F.coalesce("text", F.lit(""))))
    )
    text = F.when(lines.isNotNull(), F.array_join(lines, "\n")).otherwise(F.col("text"))
    return joined.withColumn("text", text).drop("_cited", "_above")


def _depths(parents: DataFrame) -> DataFrame:
    """Columns ``conv_id, turn, root, depth``: pointers are doubled until all reach a root.

    Only messages that have not reached one take part in a round, so a single
    long conversation does not make the short ones go round again.
    """
    first = F.col("parent").isNull()
    rows = parents.select(
        "conv_id", "turn", F.coalesce("parent", "turn").alias("root"),
        F.col("parent").isNotNull().cast("bigint").alias("depth"), first.alias("done"),
    )
    waiting = {"waiting": F.count_if(~F.col("done"))}
    table = store(rows, "replies", **waiting)
    while table.rows and table.seen["waiting"]:
        up = table.df.select(
            "conv_id", F.col("turn").alias("root"), F.col("root").alias("above"),
            F.col("depth").alias("more"), F.col("done").alias("top"),
        )
        moved = table.df.where("NOT done").join(up, ["conv_id", "root"]).select(
            "conv_id", "turn", F.col("above").alias("root"),
            (F.col("depth") + F.col("more")).alias("depth"), F.col("top").alias("done"),
        )
        table = store(table.df.where("done").unionByName(moved), "replies", **waiting)
    return table.df.drop("done")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Messages with what they reply to, and their text without quotes.

    Returns ``conv_id, turn, role, reply_to, root, depth, quoted, linked, own_text``,
    one row for each row of ``messages``; sorted by ``conv_id, root, depth, turn``
    they are in reply order. ``quoted`` counts quoted passages, ``linked`` those
    found in an earlier message (see ``linked_passages``). A message replies to
    the turn it quotes most from, the later of equal ones; one that quotes none
    to the turn before, the first to nothing. Rows that repeat a conversation and
    turn are one message with all their passages. A null text is empty; rows with
    a null conversation or turn have neither root nor depth. A very long text is
    taken whole; its lines are numbered in one task. Other columns are not read.
    """
    rows = messages.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    real = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    quotes = store(linked_passages(real), "linked").df
    votes = quotes.where("original IS NOT NULL").groupBy("conv_id", "turn", "original").agg(
        F.sum("held").alias("held")
    )
    chosen = votes.groupBy("conv_id", "turn").agg(
        F.max_by("original", F.struct("held", "original")).alias("original")
    )
    counts = quotes.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("quoted"), F.count("original").alias("linked")
    )
    parents = (
        _previous_turns(real.select("conv_id", "turn").distinct())
        .join(chosen, ["conv_id", "turn"], "left").join(counts, ["conv_id", "turn"], "left")
        .withColumn("parent", F.coalesce("original", "previous"))
    )
    parents = store(parents.select("conv_id", "turn", "parent", "quoted", "linked"), "parents").df
    depths = _depths(parents)
    known = parents.join(depths, ["conv_id", "turn"])
    own = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: ~x.rlike(_MARK))
    return rows.join(known, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", F.col("parent").alias("reply_to"), "root", "depth",
        F.coalesce("quoted", F.lit(0)).alias("quoted"), F.coalesce("linked", F.lit(0)).alias("linked"),
        F.trim(F.array_join(own, "\n")).alias("own_text"),
    )


SQL = r"""
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS r, conv_id, turn, role, text,
         trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS flat,
         ('0x' || substr(md5(conv_id || '/' || turn), 1, 8))::BIGINT AS h
  FROM conversations),
texts AS (SELECT conv_id, turn, min(flat) AS flat, any_value(h) AS h FROM given GROUP BY ALL),
quoting AS (
  SELECT t.conv_id, t.turn, t.turn - 1 - t.h % 2 AS o, t.h, string_split(p.flat, ' ') AS w
  FROM texts t JOIN texts p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1 - t.h % 2
  WHERE t.h % 4 <> 0 AND p.flat <> ''),
parts AS (
  SELECT conv_id, turn, o, list_slice(w, (h // 8) % greatest(len(w) - 20, 1) + 1,
         (h // 8) % greatest(len(w) - 20, 1) + 20) AS part FROM quoting),
cited AS (
  SELECT conv_id, turn, o, list_transform(range(1, len(part) + 1, 8),
         lambda i: '> ' || array_to_string(list_slice(part, i, i + 7), ' ')) AS cited FROM parts),
shown AS (
  SELECT g.r, g.conv_id, g.turn, g.role, CASE WHEN c.cited IS NULL THEN g.text ELSE array_to_string(
         list_concat(list_concat(list_transform(coalesce(a.cited, []), lambda x: '> ' || x), c.cited),
                     [coalesce(g.text, '')]), chr(10)) END AS text
  FROM given g LEFT JOIN cited c ON c.conv_id = g.conv_id AND c.turn = g.turn
    LEFT JOIN cited a ON a.conv_id = c.conv_id AND a.turn = c.o),
split AS (SELECT r, conv_id, turn, string_split(text, chr(10)) AS ls FROM shown),
raw AS (SELECT r, conv_id, turn, unnest(ls) AS raw, unnest(range(len(ls))) AS line FROM split),
marked AS (SELECT *, regexp_extract(raw, '^(\s*(?:>\s?)+)', 1) AS mark FROM raw),
lines AS (
  SELECT r, conv_id, turn, line, length(regexp_replace(mark, '[^>]', '', 'g')) AS level,
         lower(trim(regexp_replace(substring(raw, length(mark) + 1), '\s+', ' ', 'g'))) AS plain
  FROM marked),
begun AS (
  SELECT *, CASE WHEN lag(level) OVER t = level AND lag(plain) OVER t <> '' THEN 0 ELSE 1 END AS begins
  FROM lines WINDOW t AS (PARTITION BY r ORDER BY line)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY r ORDER BY line) AS passage FROM begun),
passages AS (
  SELECT r, conv_id, turn, passage, level, string_split(string_agg(plain, ' ' ORDER BY line), ' ') AS w
  FROM numbered WHERE plain <> '' GROUP BY r, conv_id, turn, passage, level),
placed AS (
  SELECT r, conv_id, turn, passage, level, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM passages),
shingles AS (
  SELECT *, array_to_string(list_slice(w, i, i + 3), ' ') AS s,
         i % 4 = 1 OR i = greatest(len(w) - 3, 1) AS asked FROM placed),
quotes AS (SELECT DISTINCT r, conv_id, turn, passage, level, s FROM shingles WHERE level > 0 AND asked),
holders AS (SELECT DISTINCT conv_id, turn, level + 1 AS level, s FROM shingles),
found AS (
  SELECT q.r, q.conv_id, q.turn, q.passage, q.s, max(h.turn) AS original
  FROM quotes q LEFT JOIN holders h ON h.conv_id = q.conv_id AND h.level = q.level AND h.s = q.s
    AND h.turn < q.turn GROUP BY ALL),
counted AS (
  SELECT r, conv_id, turn, passage, original, count(*) AS held,
         sum(count(*)) OVER (PARTITION BY r, passage) AS every
  FROM found GROUP BY r, conv_id, turn, passage, original),
best AS (
  SELECT r, conv_id, turn, passage,
         max((held, original)) FILTER (original IS NOT NULL) AS b, any_value(every) AS every
  FROM counted GROUP BY ALL),
linked AS (
  SELECT conv_id, turn, CASE WHEN b[1] * 2 >= every THEN b[2] END AS original,
         CASE WHEN b[1] * 2 >= every THEN b[1] END AS held FROM best),
votes AS (SELECT conv_id, turn, original, sum(held) AS held FROM linked
          WHERE original IS NOT NULL GROUP BY ALL),
chosen AS (SELECT conv_id, turn, max((held, original))[2] AS original FROM votes GROUP BY ALL),
sums AS (SELECT conv_id, turn, count(*) AS quoted, count(original) AS linked FROM linked GROUP BY ALL),
parents AS (
  SELECT k.conv_id, k.turn, quoted, linked, coalesce(original,
         lag(k.turn) OVER (PARTITION BY k.conv_id ORDER BY k.turn)) AS parent
  FROM (SELECT DISTINCT conv_id, turn FROM conversations) k
  LEFT JOIN chosen USING (conv_id, turn) LEFT JOIN sums USING (conv_id, turn)),
tree AS (
  SELECT conv_id, turn, turn AS root, 0::BIGINT AS depth FROM parents WHERE parent IS NULL
  UNION ALL
  SELECT p.conv_id, p.turn, t.root, t.depth + 1 FROM parents p JOIN tree t
  ON p.conv_id = t.conv_id AND p.parent = t.turn)
SELECT c.conv_id, CAST(c.turn AS BIGINT) AS turn, c.role, CAST(p.parent AS BIGINT) AS reply_to,
       CAST(t.root AS BIGINT) AS root, t.depth, CAST(coalesce(p.quoted, 0) AS BIGINT) AS quoted,
       CAST(coalesce(p.linked, 0) AS BIGINT) AS linked,
       trim(array_to_string(list_filter(string_split(coalesce(c.text, ''), chr(10)),
            lambda x: NOT regexp_matches(x, '^(\s*(?:>\s?)+)')), chr(10)), ' ') AS own_text
FROM shown c JOIN parents p USING (conv_id, turn) JOIN tree t USING (conv_id, turn)"""
