"""Git commits: line diffs, the commit filter, training text with change windows."""

from __future__ import annotations

from difflib import HtmlDiff, SequenceMatcher

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.hashing import keyed_index, keyed_uniform
from corpusmill.functions.text import extension

#: Fixed values of the filter.
BAD_PARTS = ("auto commit", "update contributing", "<?xml")
BAD_MESSAGES = ("readme", "update", "dummy", "updated", "debug", "test", "update readme", "update readme.md", "updated readme.md", "updated readme")
DATA_EXTENSIONS = ("json", "yml", "xml", "html")

DIFF = "struct<old_change_start:int,old_change_end:int,old_change_range:int,new_change_start:int,new_change_end:int,new_change_range:int,n_inserts:int,n_deletes:int,n_changes:int>"
DIFF_FIELDS = ("old_change_start", "old_change_end", "old_change_range", "new_change_start", "new_change_end", "new_change_range", "n_inserts", "n_deletes", "n_changes")


def line_diff(old: str | None, new: str | None, fixed: bool = False) -> tuple[int, ...]:
    """Extents and counts of changed lines. Starts are 0 unless ``fixed``, when they are the first changed lines."""
    a, b = (old or "").splitlines(), (new or "").splitlines()
    changes = [op for group in SequenceMatcher(None, a, b).get_grouped_opcodes() for op in group if op[0] != "equal"]
    inserts = sum(j2 - j1 for _, _, _, j1, j2 in changes)
    deletes = sum(i2 - i1 for _, i1, i2, _, _ in changes)
    starts = (min((c[1] for c in changes), default=0), min((c[3] for c in changes), default=0)) if fixed else (0, 0)
    ends = max((c[2] for c in changes), default=0), max((c[4] for c in changes), default=0)
    return starts[0], ends[0], ends[0] - starts[0], starts[1], ends[1], ends[1] - starts[1], inserts, deletes, inserts + deletes


def diff_stats(old: Column | str, new: Column | str) -> Column:
    """``line_diff`` of two columns as a struct."""

    @F.pandas_udf(DIFF)
    def stats(a, b):
        import pandas as pd

        return pd.DataFrame([line_diff(x, y) for x, y in zip(a, b, strict=True)], columns=list(DIFF_FIELDS))

    return stats(old, new)


def html_diff(old: Column | str, new: Column | str) -> Column:
    """A table of both sides with their differences marked, for people to look at."""

    @F.pandas_udf("string")
    def rendered(a, b):
        import pandas as pd

        return pd.Series([HtmlDiff().make_table((x or "").splitlines(), (y or "").splitlines()) for x, y in zip(a, b, strict=True)])

    return rendered(old, new)


def short_enough(contents: Column, most: int = 100_000) -> Column:
    return F.coalesce(F.char_length(contents) < most, F.lit(False))


def words(subject: Column) -> Column:
    return F.filter(F.split(subject, r"\s+", -1), lambda w: w != "")


def keeps(key: Column, new_contents: Column, old_file: Column, subject: Column, old_range: Column, short: float = 0.1, long: float = 0.1, java: float = 1.0, md: float = 1.0, data: float = 1.0, brief: float = 0.5) -> Column:
    """The commit filter; its samples are drawn by keyed hashes, so a commit's fate is fixed."""
    lowered, count, ext = F.lower(subject), F.size(words(subject)), extension(old_file)
    drawn = lambda salt, share: keyed_uniform(salt, key) <= share
    unless = lambda case, ok: ~case | ok
    kept = (new_contents != "") & unless(old_range <= 2, drawn("short", short)) & unless(old_range >= 200, drawn("long", long))
    kept = kept & unless(ext == "java", drawn("java", java)) & unless(ext == "md", drawn("md", md)) & unless(ext.isin(*DATA_EXTENSIONS), drawn("data", data))
    kept = kept & (count > 0) & ~lowered.isin(*BAD_MESSAGES) & unless(count < 5, drawn("brief", brief))
    for part in BAD_PARTS:
        kept = kept & ~lowered.contains(part)
    kept = kept & ~lowered.rlike(r"^(?:v)?\d+\.\d+\.\d+($|\S)") & (F.char_length(subject) <= 20 * count) & ~(lowered.startswith(" ") & (count == 1))
    return F.coalesce(kept, F.lit(False))


def training_text(key: Column, old: Column, new: Column, subject: Column, diff: Column, full: float = 0.2, margin: int = 32) -> Column:
    """Before, message and after; whole files for a share of ``full``, else the changed lines with keyed random margins."""
    before, after = keyed_index("start", key, margin), keyed_index("end", key, margin)

    def window(text: Column, side: str) -> Column:
        parts = F.split(F.regexp_replace(text, "\n$", ""), "\n", -1)
        count = F.when(text == "", 0).otherwise(F.size(parts))
        start = F.greatest(F.lit(0), diff[f"{side}_change_start"] - before)
        end = F.least(count, diff[f"{side}_change_end"] + after)
        return F.array_join(F.slice(parts, start + 1, F.greatest(end - start, F.lit(0))), "\n")

    whole = keyed_uniform("full", key) < full
    return F.concat(
        F.lit("<commit_before>"), F.when(whole, old).otherwise(window(old, "old")), F.lit("<commit_msg>"), subject, F.lit("<commit_after>"), F.when(whole, new).otherwise(window(new, "new"))
    )


def content_with_meta(key: Column, content: Column, repo: Column, path: Column, stars_bucket: Column, share: float = 0.2) -> Column:
    """Content after a header of repository, file and stars, each present for a keyed share of rows."""
    part = lambda salt, tag, value: F.when(keyed_uniform(salt, key) < share, F.concat(F.lit(tag), value)).otherwise("")
    header = F.concat(part("repo", "<reponame>", repo), part("file", "<filename>", path), part("stars", "<gh_stars>", stars_bucket))
    return F.concat(header, F.when(header != "", "\n").otherwise(""), content)
