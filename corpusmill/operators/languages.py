"""The map of languages to file extensions: clashes, clean-up, conflict resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Languages and extensions that are dropped or renamed, and the language that owns a shared extension.
DROPPED_LANGUAGES = ("HyPhy",)
RENAMED = {"M4Sugar": "M4", "PLSQL": "SQL", "PLpgSQL": "SQL", "SQLPL": "SQL"}
DROPPED_EXTENSIONS = (
    ".asc", ".b", ".cgi", ".ch", ".cls", ".d", ".es", ".fcgi", ".fr", ".gml", ".gs", ".inc", ".l", ".m", ".mod", ".moo", ".ms", ".n", ".ncl",
    ".nl", ".pluginspec", ".pp", ".pro", ".sc", ".tst", ".v", ".sublime-build", ".sublime-commands", ".sublime-completions", ".sublime-keymap",
    ".sublime-macro", ".sublime-menu", ".sublime-mousemap", ".sublime-project", ".sublime-settings", ".sublime-theme", ".sublime-workspace",
    ".sublime_metrics", ".sublime_session",
)
OWNERS = {
    ".bb": "BitBake", ".brd": "Eagle", ".cake": "C#", ".cl": "OpenCL", ".cp": "C++", ".cs": "C#", ".ecl": "ECL", ".f": "FORTRAN", ".for": "FORTRAN",
    ".frag": "GLSL", ".fs": "F#", ".fx": "Flux", ".g": "G-code", ".gd": "GDScript", ".h": "C", ".hh": "C++", ".j": "Jasmin", ".lisp": "Common Lisp",
    ".ls": "LiveScript", ".lsp": "Common Lisp", ".mm": "Objective-C++", ".nb": "Mathematica", ".php": "PHP", ".pm": "Perl", ".pl": "Perl", ".pod": "Pod",
    ".r": "R", ".rpy": "Ren'Py", ".rs": "Rust", ".sch": "Eagle", ".sls": "SaltStack", ".sql": "SQL", ".st": "Smalltalk", ".t": "Perl",
    ".ts": "TypeScript", ".tsx": "TypeScript", ".vhost": "ApacheConf",
}


def exploded(languages: DataFrame) -> DataFrame:
    """(name, extension) from (name, extensions)."""
    return languages.select("name", F.explode("extensions").alias("extension")).where("extension is not null")


def appended(languages: DataFrame, more: DataFrame) -> DataFrame:
    """(name, extensions) of both tables; names without a list stay out of ``exploded``."""
    return languages.select("name", "extensions").unionByName(more.select("name", "extensions"))


def clashes(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("extension").agg(F.sort_array(F.collect_set("name")).alias("names"), F.countDistinct("name").alias("n")).where("n > 1")


def resolve(pairs: DataFrame, owners: dict[str, str] | None = None, dropped: tuple[str, ...] = DROPPED_EXTENSIONS) -> DataFrame:
    """Distinct (name, extension) after renaming, dropping and giving shared extensions to their owners."""
    owners = OWNERS if owners is None else owners
    renames = F.create_map(*[F.lit(x) for pair in RENAMED.items() for x in pair])
    renamed = pairs.where(~F.col("name").isin(*DROPPED_LANGUAGES) & ~F.col("extension").isin(*dropped)).withColumn("name", F.coalesce(renames[F.col("name")], F.col("name")))
    owner = F.create_map(*[F.lit(x) for pair in owners.items() for x in pair])[F.col("extension")] if owners else F.lit(None)
    return renamed.where(owner.isNull() | (owner == F.col("name"))).select("name", "extension").distinct()


def regrouped(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("name").agg(F.sort_array(F.collect_set("extension")).alias("extensions"))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(name, side): names of one table that the other lacks."""
    left = a.select("name").distinct().join(b.select("name").distinct(), "name", "left_anti").withColumn("side", F.lit("first"))
    right = b.select("name").distinct().join(a.select("name").distinct(), "name", "left_anti").withColumn("side", F.lit("second"))
    return left.union(right)
