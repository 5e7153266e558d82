"""An index of word pairs, and of their letter runs, for literal searches in the explorer mart.

Each job stands under every two neighbouring words of its searched columns, cut at blanks, and
under a column's only word. The different pairs stand under every run of one, two and three
characters. A term of one or two words lies within a pair, so the pairs that hold it give its
jobs. Of a longer term some pairs are looked up, jobs that have all of them are candidates, and
only those are read and compared with the whole term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.operators.skills import repeated_keys
from hirelens.session import stage

COLUMNS = ("job_title", "company_name", "location_text", "skill_names")
LONGEST = 3
LOOKED_UP = 3  # of a text's runs, the rarest; of a term's pairs, the longest


def _searched(column: str) -> Column:
    return F.lower(F.coalesce(column, F.lit("")))


def _runs(text: Column, size: int) -> Column:
    last = F.greatest(F.char_length(text) - (size - 1), F.lit(0))
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substring(text, i, F.lit(size)))


def _pairs(text: Column) -> Column:
    words = F.split(text, " ", -1)
    others = F.size(words) - 1
    both = F.zip_with(
        F.slice(words, F.lit(1), others), F.slice(words, F.lit(2), others),
        lambda one, other: F.concat_ws(" ", one, other))
    return F.when(others == 0, words).otherwise(both)


def _single(explorer: DataFrame) -> DataFrame:
    """Jobs with one row. Searches have always left out jobs whose rows repeat."""
    repeated = repeated_keys(explorer, "job_id")
    return explorer.join(repeated, F.col("job_id").eqNullSafe(F.col("_repeated")), "left_anti")


def postings(explorer: DataFrame) -> DataFrame:
    """(pair, job_id), each once a row: all neighbouring words of the searched columns."""
    every = F.array_distinct(F.concat(*[_pairs(_searched(c)) for c in COLUMNS]))
    return explorer.select(F.explode(every).alias("pair"), "job_id").filter("pair <> ''")


def pair_runs(pairs: DataFrame) -> DataFrame:
    """(run, pair): all runs of the pairs, each once a pair."""
    runs = [_runs(F.col("pair"), n) for n in range(1, LONGEST + 1)]
    return pairs.select(F.explode(F.array_distinct(F.concat(*runs))).alias("run"), "pair")


def write_search_index(explorer: DataFrame, path: str) -> None:
    """Write the postings in order of their pairs and the pairs in order of their runs, so that
    a search reads the files it needs only, and how many pairs each run has. A frequent pair
    or run is spread over files."""
    rows = postings(_single(explorer))
    rows.repartitionByRange("pair", "job_id").sortWithinPartitions("pair", "job_id").write.parquet(
        f"{path}/postings")
    read = explorer.sparkSession.read
    runs = pair_runs(read.parquet(f"{path}/postings").select("pair").distinct())
    runs.repartitionByRange("run", "pair").sortWithinPartitions("run", "pair").write.parquet(
        f"{path}/pairs")
    stored = read.parquet(f"{path}/pairs")
    stored.groupBy("run").agg(F.count("*").alias("pairs")).write.parquet(f"{path}/runs")


def _holding(spark: SparkSession, path: str, parts: DataFrame) -> DataFrame:
    """(part, pair): the pairs that hold each of the different texts `parts` (part)."""
    short = F.char_length("part") <= LONGEST
    looked_up = parts.select(
        "part",
        F.explode(F.when(short, F.array("part")).otherwise(
            F.array_distinct(_runs(F.col("part"), LONGEST)))).alias("run"),
    )
    # a part with a run that no pair has finds nothing
    known = looked_up.join(spark.read.parquet(f"{path}/runs"), "run", "left")
    rarest = Window.partitionBy("part").orderBy(F.col("pairs").asc_nulls_first(), "run")
    asked = known.withColumn("_n", F.row_number().over(rarest)).filter(F.col("_n") <= LOOKED_UP)
    counts = asked.groupBy("part").agg(F.count("*").alias("_runs"))
    asked = asked.filter("pairs is not null").select("part", "run").join(counts, "part")
    return (
        spark.read.parquet(f"{path}/pairs").join(stage(asked, "search-runs"), "run")
        .groupBy("part", "pair")
        .agg(F.count("*").alias("_found"), F.first("_runs").alias("_runs"))
        .filter("_found = _runs").filter(F.contains("pair", "part")).select("part", "pair")
    )


def search(
    spark: SparkSession, path: str, explorer: DataFrame, terms: DataFrame
) -> DataFrame:
    """Jobs that hold a term in their title, company, location or skills, without regard to
    case: (term, job_id), for each row of `terms` (term).

    Terms are trimmed; equal ones count once. A blank or null term finds every job, as an
    empty search box does.
    """
    wanted = terms.select(F.lower(F.trim(F.coalesce("term", F.lit("")))).alias("term")).distinct()
    words = F.size(F.split("term", " ", -1))
    longest = F.array_sort(
        F.array_distinct(_pairs(F.col("term"))),
        lambda a, b: F.char_length(b) - F.char_length(a))
    asked = stage(
        wanted.withColumn("_parts", F.when(words <= 2, F.array("term")).otherwise(
            F.slice(longest, 1, LOOKED_UP)))
        .select("term", F.size("_parts").alias("_asked"), (words > 2).alias("_long"),
                F.explode("_parts").alias("part")),
        "search-terms")
    found = stage(
        asked.join(_holding(spark, path, asked.filter("part <> ''").select("part").distinct()),
                   "part"),
        "search-pairs")
    stored = spark.read.parquet(f"{path}/postings")
    done = stored.join(found.filter("not _long").select("term", "pair"), "pair").select(
        "term", "job_id").distinct()
    several = (
        stored.join(found.filter("_long"), "pair")
        .select("term", "job_id", "part", "_asked").distinct()
        .groupBy("term", "job_id", "_asked").agg(F.count("*").alias("_found"))
        .filter("_found = _asked").select("term", "job_id")
    )
    single = _single(explorer)
    shown = single.select("job_id", *[_searched(c).alias(c) for c in COLUMNS])
    test = F.lit(False)
    for column in COLUMNS:
        test = test | F.contains(F.col(column), F.col("term"))
    checked = several.join(shown, "job_id").filter(test).select("term", "job_id").distinct()
    blank = wanted.filter("term = ''").crossJoin(single.select("job_id"))
    return done.unionByName(checked).unionByName(blank.select("term", "job_id"))
