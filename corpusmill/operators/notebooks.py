"""Notebooks: cells from JSON, runs of cell types, markdown and code pairs, structured text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import clean_markdown
from corpusmill.sources.shared import materialize

NO_OUTPUT = "_____no_output_____"


def parse_cells(content: Column) -> Column:
    """array<struct<type, src, out>> of the non-empty cells; null where the JSON has no cells.

    A source, or an output's text, may be a string or a list of lines.
    """
    cells = F.from_json(content, "struct<cells:array<string>>")["cells"]

    def joined(value: Column) -> Column:
        listed = F.from_json(value, "array<string>")
        return F.coalesce(F.when(value.startswith("["), F.array_join(listed, "")), value, F.lit(""))

    def cell(raw: Column) -> Column:
        outputs = F.from_json(F.get_json_object(raw, "$.outputs"), "array<string>")
        texts = F.filter(F.transform(outputs, lambda o: F.get_json_object(o, "$.text")), lambda t: t.isNotNull())
        return F.struct(
            F.get_json_object(raw, "$.cell_type").alias("type"), joined(F.get_json_object(raw, "$.source")).alias("src"), F.coalesce(joined(F.get(texts, F.lit(0))), F.lit("")).alias("out")
        )

    parsed = F.filter(F.transform(cells, cell), lambda c: c["src"] != "")
    return F.transform(parsed, lambda c: F.struct(c["type"].alias("type"), c["src"].alias("src"), F.when(c["out"] == "", NO_OUTPUT).otherwise(c["out"]).alias("out")))


def is_python(content: Column) -> Column:
    return F.coalesce(F.get_json_object(content, "$.metadata").contains("py"), F.lit(False))


def script_extension(content: Column) -> Column:
    """The metadata's file extension, .py for a Python kernel, else null (a language guesser's case)."""
    listed = F.get_json_object(content, "$.metadata.language_info.file_extension")
    return F.coalesce(listed, F.when(F.get_json_object(content, "$.metadata.kernelspec").contains("py"), ".py"))


def run_lengths(rows: DataFrame, key: str, order: str, kind: str) -> DataFrame:
    """(key, run, kind, first, n) of each run of consecutive rows of one kind."""
    by = Window.partitionBy(key).orderBy(order)
    changes = (F.lag(kind).over(by).isNull() | (F.lag(kind).over(by) != F.col(kind))).cast("int")
    numbered = rows.withColumn("run", F.sum(changes).over(by) - 1)
    return numbered.groupBy(key, "run", kind).agg(F.min(order).alias("first"), F.count("*").alias("n"))


def triplets(rows: DataFrame, key: str, order: str, kind: str, src: str, out: str) -> DataFrame:
    """(key, pair, markdown, code, output): runs paired after a leading code run and a trailing markdown run were
    dropped; keys with an odd number of runs left give none."""
    by = Window.partitionBy(key).orderBy(order)
    changes = (F.lag(kind).over(by).isNull() | (F.lag(kind).over(by) != F.col(kind))).cast("int")
    runs = rows.withColumn("run", F.sum(changes).over(by)).groupBy(key, "run", kind).agg(F.sort_array(F.collect_list(F.struct(order, src, out))).alias("cells"))
    whole = Window.partitionBy(key)
    kept = runs.withColumn("last", F.max("run").over(whole)).where(~((F.col("run") == 1) & (F.col(kind) == "code")) & ~((F.col("run") == F.col("last")) & (F.col(kind) == "markdown")))
    placed = kept.withColumn("n", F.count("*").over(whole)).withColumn("i", F.row_number().over(Window.partitionBy(key).orderBy("run")) - 1).where("n % 2 = 0")
    following = placed.withColumn("code_cells", F.lead("cells").over(Window.partitionBy(key).orderBy("run"))).where("i % 2 = 0")
    return following.select(
        key,
        (F.col("i") / 2).cast("int").alias("pair"),
        F.array_join(F.transform("cells", lambda c: clean_markdown(c[src])), " ").alias("markdown"),
        F.array_join(F.transform("code_cells", lambda c: c[src]), "\n").alias("code"),
        F.element_at("code_cells", -1)[out].alias("output"),
    )


def structured(markdown: Column, code: Column, output: Column) -> Column:
    cut = F.when(F.char_length(output) > 1000, F.concat(F.substring(output, 1, 1000), F.lit("[...]"))).when(output == NO_OUTPUT, "<empty_output>").otherwise(output)
    strip = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.concat(F.lit("<jupyter_text>"), strip(markdown), F.lit("<jupyter_code>"), strip(code), F.lit("<jupyter_output>"), strip(cut))


def chain(rows: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """(key, first, content, chain_length): consecutive rows of one key, in the order of ``order`` over the whole table, joined
    behind a start mark. A key that comes again after another starts a new chain.

    Breaks are found without ordering the whole table in one task: rows are dealt by ranges of ``order``, chains are
    found within a range, and the range's last key decides whether the next range's first chain goes on.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(F.col(key).alias("k"), F.col(order).alias("o"), F.col(text).alias("t")).repartitionByRange(parts, "o")
    dealt = materialize(dealt.withColumn("p", F.spark_partition_id()), "ranges")
    by = Window.partitionBy("p").orderBy("o")
    marked = dealt.withColumn("breaks", (~F.col("k").eqNullSafe(F.lag("k").over(by)) | F.lag("o").over(by).isNull()).cast("int"))
    # one row a range: whether its first row goes on with the last key of the range before, and its chains
    ends = marked.groupBy("p").agg(F.min_by("k", "o").alias("first"), F.max_by("k", "o").alias("last"), F.sum("breaks").alias("n"))
    ordered = Window.orderBy("p")
    goes_on = F.coalesce(F.col("first").eqNullSafe(F.lag("last").over(ordered)) & F.lag("p").over(ordered).isNotNull(), F.lit(False))
    own = F.col("n") - goes_on.cast("int")
    bases = ends.select("p", own.alias("own"), goes_on.alias("goes_on")).select("p", (F.sum("own").over(ordered) - F.col("own")).alias("base"), F.col("goes_on").cast("int").alias("shift"))
    numbered = marked.join(F.broadcast(bases), "p").withColumn("run", F.col("base") - F.col("shift") + F.sum("breaks").over(by))
    joined = numbered.groupBy("run", "k").agg(F.sort_array(F.collect_list(F.struct("o", "t"))).alias("parts"))
    return joined.select(F.col("k").alias(key), F.col("parts")[0]["o"].alias("first"), F.concat(F.lit("<jupyter_start>"), F.array_join(F.transform("parts", lambda p: p["t"]), "")).alias("content"), F.size("parts").alias("chain_length"))
