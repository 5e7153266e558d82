"""Skill extraction, normalisation, vocabulary, aliases and job links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.functions import answers, payload
from hirelens.functions.once import with_computed
from hirelens.functions.skills import (
    canonical_name,
    is_rejected,
    is_safe_alias,
    known_category,
    normalize_category,
    skill_category,
    strip_fences,
    word_tokens,
)
from hirelens.functions.text import blank_if_null, lookup_key
from hirelens.operators.keyed import (
    assign_ids,
    fill_empty,
    largest_id,
    least_rows,
    new_rows,
    upsert,
)
from hirelens.session import stage

# A dictionary is broadcast up to this many bytes; beyond it its joins are planned as adaptive
# execution decides.
MAX_BROADCAST_BYTES = 32 << 20

BAD_JSON = "response is not a JSON object"
NOT_A_LIST = "field 'skills' is not a list"


def worklist(
    jobs: DataFrame, analysis: DataFrame, links: DataFrame, force: bool = False
) -> DataFrame:
    """Jobs to extract skills from: described, not excluded, and - unless forced -
    without any skill so far. Jobs never analysed are included."""
    judged = analysis.select("job_id", "is_excluded_from_analysis")
    todo = (
        jobs.select("job_id", "job_title", "description_text")
        .filter(F.col("description_text").isNotNull())
        .join(judged, "job_id", "left")
        .filter(~F.coalesce("is_excluded_from_analysis", F.lit(False)))
        .select("job_id", "job_title", "description_text")
    )
    if force:
        return todo
    return todo.join(links.select("job_id").distinct(), "job_id", "left_anti")


# --- responses ---------------------------------------------------------------


def parse_responses(responses: DataFrame) -> DataFrame:
    """Add the parsed skill list and the failure, if any, of each response.

    A missing or null list is empty; anything but a list fails the job. Lists of plain skills
    are read by `answers.read`, all other texts become variants.
    """
    bare = with_computed(responses, {"_bare": strip_fences(F.col("response_text"))})
    read = bare.withColumn("_read", answers.read(F.col("_bare")))
    taken = F.col("_read.taken")
    parsed = with_computed(read, {"_json": payload.parse(F.when(~taken, F.col("_bare")))})
    parsed = with_computed(
        parsed, {"_list": payload.field(F.col("_json"), "skills", "array<variant>")}
    )
    is_object = F.col("_json").isNotNull() & F.col("_bare").startswith("{")
    skills = payload.field(F.col("_json"), "skills", "variant")
    empty = skills.isNull() | F.is_variant_null(skills)
    failure = (
        F.when(taken, F.lit(None))
        .when(~F.coalesce(is_object, F.lit(False)), BAD_JSON)
        .when(F.col("_list").isNull() & ~empty, NOT_A_LIST)
    )
    number = "confidence_score"
    items = F.transform("_list", lambda item: F.struct(
        *[payload.field(item, c).alias(c) for c in ITEM if c not in ("position", number)],
        payload.field(item, number, "double").alias(number),
    ))
    skills = F.when(taken, F.col("_read.items")).otherwise(items)
    return parsed.select(
        *responses.columns, skills.alias("skill_list"), failure.alias("failure")
    )


ITEM = ["position", "skill_name", "skill_category", "raw_mention", "confidence_score"]


def response_lists(parsed: DataFrame, strict_reject: bool = False) -> DataFrame:
    """Validated, normalised skills of each response as an array in one row: job_id, failure,
    items. Nothing is shuffled; `deduplicate` takes these lists as they are."""
    number = "confidence_score"
    made = parsed.select("job_id", "failure", "skill_list").withColumn(
        "_made", answers.normalize(F.col("skill_list"), strict_reject))
    taken = F.col("_made.taken")
    raw = F.transform(F.when(~taken, F.col("skill_list")), lambda item, i: F.struct(
        i.alias("position"),
        *[blank_if_null(item[c]).alias(c) for c in ITEM if c not in ("position", number)],
        item[number].alias(number),
    ))
    named = F.transform(raw, lambda i: F.struct(
        i["position"].alias("position"),
        canonical_name(i["skill_name"], F.lower(i["skill_name"])).alias("skill_name"),
        known_category(i["skill_category"], F.lower(i["skill_category"])).alias("skill_category"),
        i["raw_mention"].alias("raw_mention"),
        i[number].alias(number),
    ))
    kept = F.filter(named, lambda i: (i["skill_name"] != "") & ~is_rejected(
        i["skill_name"], strict_reject))
    items = F.transform(kept, lambda i: F.struct(
        i["position"].alias("position"),
        i["skill_name"].alias("skill_name"),
        skill_category(i["skill_name"], i["skill_category"]).alias("skill_category"),
        F.when(i["raw_mention"] != "", i["raw_mention"]).otherwise(i["skill_name"])
        .alias("raw_mention"),
        F.when((i[number] >= 0) & (i[number] <= 1) & ~F.isnan(i[number]), i[number])
        .alias(number),
    ))
    items = F.when(taken, F.col("_made.items")).otherwise(items)
    return with_computed(made, {"items": items}).select("job_id", "failure", "items")


def response_items(parsed: DataFrame, strict_reject: bool = False) -> DataFrame:
    """Validated, normalised skills of the good responses, one row per list item. `parsed` may
    be responses with their lists made already."""
    lists = parsed if "items" in parsed.columns else response_lists(parsed, strict_reject)
    return lists.select("job_id", F.inline("items"))  # failed responses have no list


def responses_with_items(lists: DataFrame) -> DataFrame:
    """Each response's job and failure with the items of its job, one row per item, or one
    without an item. `lists` (`response_lists`) is read several times and should be stored."""
    repeated = repeated_keys(lists.filter("job_id is not null"), "job_id")
    same = F.col("job_id") == F.col("_repeated")
    once = lists.filter("job_id is not null").join(repeated, same, "left_anti")
    again = lists.join(repeated, same, "left_semi").unionByName(lists.filter("job_id is null"))
    return once.select("job_id", "failure", F.inline_outer("items")).unionByName(
        again.select("job_id", "failure").join(response_items(again), "job_id", "left"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys, null too, that several rows have; stored, so that few of them are broadcast."""
    return stage(df.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(
        F.col(key).alias("_repeated")), "repeated")


def deduplicate(items: DataFrame) -> DataFrame:
    """One row per job and skill name ignoring case: highest confidence (missing
    counts as 0), then earliest; it takes the place of the earliest.

    Of responses with lists (`response_lists`), which are read twice and should be stored, each
    is done in its own row; only jobs with several responses are grouped.
    """
    if "items" in items.columns:
        repeated = repeated_keys(items, "job_id")
        same = F.col("job_id").eqNullSafe(F.col("_repeated"))
        once = _distinct_items(items.join(repeated, same, "left_anti"))
        again = response_items(items.join(repeated, same, "left_semi"))
        return once.unionByName(deduplicate(again))
    keyed = items.withColumn("_key", lookup_key(F.col("skill_name")))
    rest = ["skill_name", "skill_category", "raw_mention", "confidence_score"]
    order = F.struct(-F.coalesce("confidence_score", F.lit(0.0)), F.col("position"))
    best = keyed.groupBy("job_id", "_key").agg(
        F.min("position").alias("position"), F.min_by(F.struct(*rest), order).alias("_row")
    )
    return best.select("job_id", "position", *[F.col("_row")[c].alias(c) for c in rest])


def _distinct_items(lists: DataFrame) -> DataFrame:
    """The rows that `deduplicate` gives, for lists of different jobs. Lists that
    `answers.distinct` leaves are sorted by key and rank, and by key and position; the items of
    a key begin at the same place in both."""
    key = lambda i: F.lower(i["skill_name"])  # noqa: E731 - names are collapsed already
    done = lists.select("job_id", "items").withColumn("_done", answers.distinct(F.col("items")))
    done = done.withColumn("_left", F.when(~F.col("_done.taken"), F.col("items")))
    ranked = F.sort_array(F.transform("_left", lambda i: F.struct(
        key(i), -F.coalesce(i["confidence_score"], F.lit(0.0)), i["position"], i.alias("item"))))
    placed = F.sort_array(F.transform("_left", lambda i: F.struct(
        key(i).alias("key"), i["position"].alias("position"))))
    both = with_computed(done, {"_ranked": ranked, "_placed": placed})
    before = lambda n: F.get("_placed", n - 1)["key"]
    rest = [c for c in ITEM if c != "position"]
    best = F.filter(
        F.transform("_placed", lambda p, n: F.when(
            (n == 0) | (before(n) != p["key"]),
            F.struct(p["position"].alias("position"),
                     *[F.get("_ranked", n)["item"][c].alias(c) for c in rest]))),
        lambda b: b.isNotNull())
    best = F.when(F.col("_done.taken"), F.col("_done.items")).otherwise(best)
    return both.select("job_id", F.inline(best))


def extraction_report(parsed: DataFrame, extracted: DataFrame) -> DataFrame:
    """Jobs processed, links saved and jobs failed."""
    jobs = parsed.agg(
        F.count_if(F.col("failure").isNull()).alias("jobs_processed"),
        F.count_if(F.col("failure").isNotNull()).alias("failed_jobs"),
    )
    links = extracted.agg(F.count("*").alias("links_saved"))
    rows = jobs.unionByName(links, allowMissingColumns=True)
    return rows.agg(
        *[F.max(c).alias(c) for c in ("jobs_processed", "links_saved", "failed_jobs")]
    )


# --- dictionary extraction ---------------------------------------------------


def alias_phrases(aliases: DataFrame, owner: str = "skill_id") -> DataFrame:
    """Alias rows with the alias as the phrase that texts are cut into."""
    words = word_tokens(F.col("alias_name"))
    return aliases.select(
        owner, F.array_join(words, " ").alias("phrase"), F.size(words).alias("words"),
        F.get(words, F.lit(0)).alias("first_word"),
    ).filter("words > 0")


def phrase_index(dictionary: DataFrame) -> DataFrame:
    """How many words the phrases have that begin with a word: one short row per first word,
    however many phrases share it."""
    return dictionary.groupBy("first_word").agg(F.collect_set("words").alias("sizes"))


def _windows(texts: DataFrame, longest: int) -> DataFrame:
    """Each word of a text with the words after it, as many as the longest phrase has."""
    cut = with_computed(texts.select("job_id", "text"), {"_words": word_tokens(F.col("text"))})
    following = [
        F.slice("_words", F.lit(n), F.greatest(F.size("_words"), F.lit(0)))
        for n in range(2, longest + 1)
    ]
    window = F.arrays_zip("_words", *following)
    names = [f"w{n}" for n in range(1, longest + 1)]
    return cut.select("job_id", F.inline(window)).toDF("job_id", *names)


def extract_by_dictionary(
    texts: DataFrame,
    aliases: DataFrame,
    owner: str = "skill_id",
    max_inline: int | None = None,
) -> DataFrame:
    """Skills whose alias occurs as a run of words anywhere in the text.

    ``texts`` has job_id and text, ``aliases`` has alias_name and the owner
    column that names the skill. The result is one row per job and owner with
    the alphabetically first matching alias as the mention. Whole texts are
    searched.

    Places of a text whose word begins an alias are found with the index of first
    words; only there the runs of the lengths that such aliases have are made, and
    they meet the aliases by a join. Dictionaries of any size take this one way;
    ``max_inline`` has no effect and stays for callers that pass it. One row of
    measures, taken when the plan is made, tells the longest alias and whether the
    dictionary is small enough to be broadcast.
    """
    dictionary = alias_phrases(aliases, owner)
    longest, size = dictionary.agg(F.max("words"), F.sum(F.octet_length("phrase") + 64)).first()
    longest = longest or 1
    index, phrases = phrase_index(dictionary), dictionary.select(owner, "phrase").distinct()
    if (size or 0) <= MAX_BROADCAST_BYTES:
        index, phrases = F.broadcast(index), F.broadcast(phrases)
    words = [F.col(f"w{n}") for n in range(1, longest + 1)]
    at = _windows(texts, longest).join(index, F.col("w1") == F.col("first_word"))
    runs = F.transform(
        F.filter("sizes", lambda n: F.get(F.array(*words), n - 1).isNotNull()),
        lambda n: F.array_join(F.slice(F.array(*words), 1, n), " "),
    )
    matched = at.select("job_id", F.explode(runs).alias("phrase"))
    found = matched.join(phrases, "phrase")
    return found.groupBy("job_id", owner).agg(F.min("phrase").alias("raw_mention"))


def dictionary_candidates(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Dictionary matches shaped like validated response items; aliases name their skill."""
    found = extract_by_dictionary(texts, aliases, "skill_name")
    category = normalize_category(F.col("skill_name"), F.lit(None).cast("string"))
    return found.select(
        "job_id",
        F.lit(0).alias("position"),
        "skill_name",
        category.alias("skill_category"),
        "raw_mention",
        F.lit(None).cast("double").alias("confidence_score"),
    )


# --- vocabulary, aliases, links ----------------------------------------------


def vocabulary_key(name):
    return F.lower(F.trim(name))


def _first_by_key(candidates: DataFrame) -> DataFrame:
    """First candidate of each skill name in arrival order, ignoring case. Candidates of
    one job and position follow each other by name and mention."""
    order = F.struct("job_id", "position", "skill_name", "raw_mention")
    keyed = candidates.select(
        vocabulary_key("skill_name").alias("_key"), "skill_name", "skill_category", "job_id",
        "position", "raw_mention")
    return least_rows(keyed, ["_key"], "job_id").groupBy("_key").agg(
        F.min_by(F.struct("skill_name", "skill_category", "job_id", "position"), order).alias(
            "_row"
        )
    )


def upsert_skills(skills: DataFrame, candidates: DataFrame) -> DataFrame:
    """Vocabulary after the refresh.

    A known name is reused whatever its case and keeps its category unless that
    is empty; the first spelling of a new name becomes the canonical one.
    """
    now = F.current_timestamp()
    first = _first_by_key(candidates)
    # of several stored spellings the one with the smallest id is the one used
    owners = skills.groupBy(vocabulary_key("skill_name").alias("_key")).agg(
        F.min("skill_id").alias("skill_id")
    )
    touched = first.join(owners, "_key").select(
        "skill_id", F.col("_row.skill_category").alias("_category")
    )
    known = skills.join(touched, "skill_id", "left").select(
        "skill_id",
        "skill_name",
        F.when(
            F.col("_category").isNotNull(), fill_empty(F.col("skill_category"), F.col("_category"))
        ).otherwise(F.col("skill_category")).alias("skill_category"),
        "created_at",
        F.when(F.col("_category").isNotNull(), now).otherwise(F.col("updated_at")).alias(
            "updated_at"
        ),
    )
    fresh = first.join(owners, "_key", "left_anti").select(
        F.col("_row.skill_name").alias("skill_name"),
        F.col("_row.skill_category").alias("skill_category"),
        F.col("_row.job_id").alias("job_id"),
        F.col("_row.position").alias("position"),
    )
    numbered = assign_ids(
        fresh, "skill_id", ["job_id", "position", "skill_name"], largest_id(skills, "skill_id")
    )
    return known.unionByName(
        numbered.select(
            "skill_id", "skill_name", "skill_category",
            now.alias("created_at"), now.alias("updated_at"),
        )
    )


def with_skill_ids(candidates: DataFrame, skills: DataFrame) -> DataFrame:
    """Candidates with the id of their skill. The ids are stored first, so that those of a
    small vocabulary are broadcast and the candidates stay where they are."""
    owners = stage(
        skills.groupBy(vocabulary_key("skill_name").alias("_key")).agg(
            F.min("skill_id").alias("skill_id")
        ),
        "owners",
    )
    keyed = candidates.withColumn("_key", vocabulary_key("skill_name"))
    return keyed.join(owners, "_key").drop("_key")


def alias_candidates(linked: DataFrame) -> DataFrame:
    """Safe aliases in arrival order: each row's mention, then its canonical name."""
    both = linked.select(
        "skill_id",
        "job_id",
        "position",
        "skill_name",
        F.posexplode(F.array("raw_mention", "skill_name")).alias("kind", "alias"),
    )
    safe = both.filter(is_safe_alias(F.col("alias"), F.col("skill_name")))
    return safe.select(
        lookup_key(F.col("alias")).alias("alias_name"), "skill_id", "job_id", "position", "kind",
        "skill_name",
    )


def new_aliases(existing: DataFrame, linked: DataFrame) -> DataFrame:
    """Aliases to add: the first skill to use a mention owns it. A skill's equal mentions give
    equal aliases, so only those of the first job are looked at."""
    first = least_rows(linked, ["skill_id", "skill_name", "raw_mention"], "job_id")
    return new_rows(
        existing, alias_candidates(first), ["alias_name"],
        ["job_id", "position", "kind", "skill_name", "skill_id"],
    )


def insert_aliases(existing: DataFrame, linked: DataFrame) -> DataFrame:
    numbered = assign_ids(
        new_aliases(existing, linked),
        "skill_alias_id",
        ["job_id", "position", "kind", "alias_name"],
        largest_id(existing, "skill_alias_id"),
    )
    added = numbered.select(
        "skill_alias_id", "skill_id", "alias_name", F.current_timestamp().alias("created_at")
    )
    return existing.select(*added.columns).unionByName(added)


LINK_KEY = ["job_id", "skill_id"]
LINK_UPDATED = ["extraction_method", "raw_mention", "confidence_score"]
LINK_ORDER = ["position", "raw_mention", "confidence_score"]


def link_rows(linked: DataFrame, method: str) -> DataFrame:
    """Links as they are stored, and their position in the answer."""
    return linked.select(
        "job_id",
        "skill_id",
        F.lit(method).alias("extraction_method"),
        "raw_mention",
        F.round("confidence_score", 4).cast("decimal(5,4)").alias("confidence_score"),
        "position",
    )


def upsert_links(
    existing: DataFrame, linked: DataFrame, method: str, replace_links: bool = False
) -> DataFrame:
    """Job-skill links after the refresh; the last write of a pair wins.

    ``replace_links`` first drops the stored links of the jobs at hand; by
    default links that are no longer extracted stay.
    """
    rows = link_rows(linked, method)
    if replace_links:
        existing = existing.join(rows.select("job_id").distinct(), "job_id", "left_anti").select(
            *existing.columns
        )
    return upsert(
        existing,
        rows,
        LINK_KEY,
        LINK_UPDATED,
        LINK_ORDER,
        on_insert={"created_at": F.current_timestamp()},
    )


def seed_aliases(spark) -> DataFrame:
    """Alias and skill-name pairs known before any data: the fixed vocabulary."""
    from hirelens import fixed_values as V

    pairs = {k.lower(): v for k, v in V.CANONICAL_SKILLS.items()}
    for name in [*V.CANONICAL_SKILLS.values(), *V.CATEGORY_BY_SKILL]:
        pairs.setdefault(name.lower(), name)
    return spark.createDataFrame(list(pairs.items()), "alias_name string, skill_name string")
