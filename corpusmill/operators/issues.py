"""Issue threads: arrays of events (author, text) cleaned, stripped of bots, filtered and masked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import let

#: Bot authors: fixed values. Keywords and suffixes are compared with the lower-case author, names as they are.
BOT_KEYWORDS = ("[bot]", "botmanager", "bors-", "jenkins", "k8s-", "-test-", "travis")
BOT_SUFFIXES = (
    "-automaton", "-automation", "-benchmark", "-build", "-deployer", "-cloud", "bot", "-ci", "-linter", "-teamcity", "-test", "-testing", "-Service-Account",
)
BOT_NAMES = (
    "Apache-HBase", "AutorestCI", "CLAassistant", "cmsbuild", "codecov-io", "codecov-commenter", "coveralls", "danger-public", "dnfclas",
    "msftclas", "PyDocTeur", "SparkQA", "karma-pr-reporter", "danger-public", "claassistantio", "probot-stale",
)

#: Boilerplate of mails: fixed values, matched at the start of a text. What is kept are the first and the third group.
MAIL_PATTERNS = (
    r"(?s)^(.*)From:.+Reply to this email directly.+view it on GitHub(.*)\n?(.*)",
    r"(?s)^(.*)On.+notifications@github.com.+wrote:.+Reply to this email directly.+view it on GitHub(.*)\n?(.*)",
    r"(?s)^(.*)Signed-off-by: .+<.+>(.*?)\n?(.*)",
)
MAIL_DATE = r"[0-9]+/[0-9]+/[0-9]+ [0-9]{2}:[0-9]{2} [AP]M.+wrote"
#: White space that is stripped from both ends of a text or line.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def event_text(comment: Column, description: Column) -> Column:
    filled = lambda c: F.coalesce(c, F.lit(""))
    return F.when(filled(comment) != "", comment).when(filled(description) != "", description).otherwise("")


def truncate(text: Column, most: int = 80, head: int = 60, tail: int = 20) -> Column:
    parts = F.split(text, "\n", -1)
    cut = F.concat(F.slice(parts, 1, head), F.array(F.lit("[Truncated]")), F.slice(parts, -tail, tail))
    return F.when(F.size(parts) > most, F.array_join(cut, "\n")).otherwise(text)


def is_bot(author: Column) -> Column:
    lowered = F.lower(author)
    found = author.isin(*BOT_NAMES)
    for word in BOT_KEYWORDS:
        found = found | lowered.contains(word)
    for suffix in BOT_SUFFIXES:
        found = found | lowered.endswith(suffix)
    return F.coalesce(found, F.lit(False))


def without_bots(events: Column) -> Column:
    """Events (author, text) without bots and without what called them.

    A kept event right before a bot goes too if it names the bot or starts with a slash; this holds
    once a bot was removed at a place after the first, so the first removed bot takes nothing along.
    """
    empty = F.struct(F.slice(events, 1, 0).alias("kept"), F.lit(0).alias("last"), F.lit(0).alias("i"))

    def step(acc, e):
        kept, last, i = acc["kept"], acc["last"], acc["i"]
        before = F.get(events, i - 1)["text"]
        calls = (i > 0) & (last > 0) & (last < i - 1) & (before.contains(e["author"]) | before.startswith("/"))
        shorter = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        gone = F.struct(F.when(F.coalesce(calls, F.lit(False)), shorter).otherwise(kept).alias("kept"), i.alias("last"), (i + 1).alias("i"))
        stays = F.struct(F.concat(kept, F.array(e)).alias("kept"), last.alias("last"), (i + 1).alias("i"))
        return F.when(is_bot(e["author"]), gone).otherwise(stays)

    return F.aggregate(events, empty, step, lambda acc: acc["kept"])


def masked(events: Column) -> Column:
    """Events whose authors, by first appearance, are username_0, username_1, ... in the author field and all texts."""

    def renamed(authors: Column) -> Column:
        name = lambda a: F.concat(F.lit("username_"), (F.array_position(authors, a) - 1).cast("string"))
        hide = lambda t: F.aggregate(authors, t, lambda acc, a: F.replace(acc, a, name(a)))
        return F.transform(events, lambda e: F.struct(name(e["author"]).alias("author"), hide(e["text"]).alias("text")))

    return let(F.array_distinct(F.transform(events, lambda e: e["author"])), renamed)


def size_of(events: Column) -> Column:
    return F.aggregate(events, F.lit(0), lambda a, e: a + F.char_length(e["text"]))


def user_count(events: Column) -> Column:
    return F.size(F.array_distinct(F.transform(events, lambda e: e["author"])))


def keeps(users: Column, size: Column, events: Column, least: int = 200, most: int = 7000, max_events: int = 10) -> Column:
    """Enough text, and several users or else not too much text in few events."""
    return (size >= least) & ((users >= 2) | ((size <= most) & (events <= max_events)))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def strip_mail(text: Column) -> Column:
    """Without mail boilerplate: the first pattern that matches at the start decides, else the lines are scanned.

    The scan starts at the last line that has the notification address or a date header, or at the first line
    if none has, and ends at the last quoted line or line with the reply notice (the one after it, if that line ends
    with a colon), or before the first line if there is none; what lies between goes. A null text is empty.
    """

    def scanned(whole: Column) -> Column:
        return let(F.split(whole, "\n", -1), outside)

    def outside(lines: Column) -> Column:
        bare = F.transform(lines, stripped)
        starts = F.transform(bare, lambda x, i: F.when(x.contains("notifications@github.com") | x.rlike(MAIL_DATE), i))
        replied = lambda x, i: F.when(x.contains("Reply to this email directly"), F.when(x.endswith(":"), i + 1).otherwise(i))
        ends = F.transform(bare, lambda x, i: F.when(x.startswith(">"), i).otherwise(replied(x, i)))
        placed = F.transform(ends, lambda e, i: F.when(e.isNotNull(), F.struct(i.alias("line"), e.alias("end"))))
        start, end = F.coalesce(F.array_max(starts), F.lit(0)), F.coalesce(F.array_max(placed)["end"], F.lit(-1))
        return F.array_join(F.concat(F.slice(lines, 1, start), F.slice(lines, end + 2, F.size(lines))), "\n")

    def cut(whole: Column) -> Column:
        found = scanned(whole)
        for pattern in reversed(MAIL_PATTERNS):
            found = F.when(whole.rlike(pattern), F.concat(F.regexp_extract(whole, pattern, 1), F.regexp_extract(whole, pattern, 3))).otherwise(found)
        return stripped(F.regexp_replace(found, "_{20,}", ""))

    return let(stripped(F.coalesce(text, F.lit(""))), cut)


def clean(events: Column) -> Column:
    """Mail boilerplate off, long texts truncated, bots removed; (author, text) events."""
    tidy = F.transform(events, lambda e: F.struct(e["author"].alias("author"), truncate(strip_mail(e["text"])).alias("text")))
    return without_bots(tidy)


def run_pipeline(threads: DataFrame, events: str = "events") -> tuple[DataFrame, DataFrame]:
    """(kept threads, report) of the whole chain over ``events`` of (author, text).

    Columns added: text_size, user_count, event_count, modified_by_bot, modified_usernames. The report has the rows and the
    characters after each step; all steps are taken in one pass over flags.
    """
    e = F.col(events)
    tidy = threads.withColumn("__n", F.size(e)).withColumn(events, F.transform(e, lambda x: F.struct(x["author"].alias("author"), strip_mail(x["text"]).alias("text"))))
    tidy = tidy.withColumn("__stripped", size_of(e)).withColumn(events, F.transform(e, lambda x: F.struct(x["author"].alias("author"), truncate(x["text"]).alias("text")))).withColumn("__cut", size_of(e))
    tidy = tidy.withColumn("__before", F.size(e)).withColumn(events, without_bots(e)).withColumn("modified_by_bot", F.size(e) < F.col("__before"))
    sized = tidy.withColumn("text_size", size_of(e)).withColumn("user_count", user_count(e)).withColumn("event_count", F.size(e))
    human = F.col("event_count") > 0
    kept = human & keeps(F.col("user_count"), F.col("text_size"), F.col("event_count"))
    steps = [("loaded", F.lit(True), "__stripped"), ("truncate", F.lit(True), "__cut"), ("bots", human, "text_size"), ("users and size", kept, "text_size")]
    sums = [F.coalesce(F.sum(F.when(ok, v)), F.lit(0)).alias(f"{n}{i}") for i, (_, ok, size) in enumerate(steps) for n, v in (("c", F.lit(1)), ("b", F.col(size)))]
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"), F.col(f"c{i}").alias("rows"), F.col(f"b{i}").alias("size")) for i, (name, _, _) in enumerate(steps)])
    report = sized.agg(*sums).select(F.explode(rows).alias("s")).select("s.*")
    named = sized.where(kept).withColumn("__m", masked(e)).withColumn("modified_usernames", F.col("__m") != e).withColumn(events, F.col("__m"))
    return named.drop("__n", "__stripped", "__cut", "__before", "__m"), report
