"""Role rules, exclusion words and documented seniority classes.

Title and context are each read once, for the phrases of all rules together. A rule is
then a lookup of the phrases found, giving ``rule id TAB reason`` or NULL; ``coalesce`` over
the rules in priority order stops at the first hit, and role and confidence follow from
the id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.literals import literal_map
from hirelens.functions.once import with_computed
from hirelens.functions.phrases import PhraseIndex
from hirelens.functions.text import first_phrase, match_text


@dataclass(frozen=True)
class RoleRule:
    role: str
    confidence: str
    reason: str
    on_title: bool
    phrases: Sequence[str]
    also_in_context: str | None = None
    second_reason: str | None = None
    second_phrases: Sequence[str] = ()

    def explain(self, number: int, texts: RuleTexts) -> Column:
        found = texts.title if self.on_title else texts.context
        parts = [F.lit(self.reason), texts.index.first(found, f"{number} first")]
        if self.second_reason:
            parts += [
                F.lit(self.second_reason), texts.index.first(texts.context, f"{number} second")
            ]
        reason = F.concat(*parts)
        if self.also_in_context:
            return F.when(texts.index.has(texts.context, f"{number} also"), reason)
        return reason


@dataclass(frozen=True)
class RuleTexts:
    """The phrases of numbered rules, and what of them title and context hold."""

    index: PhraseIndex
    title: Column
    context: Column


def rule_phrases(rules: Sequence[RoleRule]) -> PhraseIndex:
    lists = {}
    for number, rule in enumerate(rules):
        lists[f"{number} first"] = rule.phrases
        lists[f"{number} second"] = rule.second_phrases
        lists[f"{number} also"] = [rule.also_in_context] if rule.also_in_context else []
    return PhraseIndex(lists)


# Priority order: each role's title rule, then its context rule.
ROLE_RULES = [
    RoleRule("machine_learning_engineer", "0.95", "Title contains ML engineering phrase: ",
             True, V.ML_TITLES),
    RoleRule("machine_learning_engineer", "0.75", "Context contains ML engineering signal: ",
             False, V.ML_SIGNALS),
    RoleRule("analytics_engineer", "0.95", "Title contains analytics engineering phrase: ",
             True, V.ANALYTICS_ENGINEER_TITLES),
    RoleRule("analytics_engineer", "0.70", "Context suggests analytics engineering: ",
             False, V.ANALYTICS_ENGINEER_SIGNALS, also_in_context="analytics"),
    RoleRule("data_engineer", "0.95", "Title contains data engineering phrase: ",
             True, V.DATA_ENGINEER_TITLES),
    RoleRule("data_engineer", "0.75", "Context contains data engineering signal: ",
             False, V.DATA_ENGINEER_SIGNALS, also_in_context="engineer"),
    RoleRule("data_scientist", "0.95", "Title contains data science phrase: ",
             True, V.DATA_SCIENTIST_TITLES),
    RoleRule("data_scientist", "0.70", "Context contains data science signal: ",
             False, V.DATA_SCIENTIST_SIGNALS, also_in_context="data"),
    RoleRule("bi_analyst", "0.95", "Title contains BI/reporting phrase: ", True, V.BI_TITLES),
    RoleRule("data_analyst", "0.90", "Title contains data analyst phrase: ",
             True, V.DATA_ANALYST_TITLES),
    RoleRule("data_analyst", "0.70", "Title contains analyst signal: ",
             True, V.ANALYST_TITLE_SIGNALS,
             second_reason="; context contains data-analysis signal: ",
             second_phrases=V.DATA_ANALYSIS_SIGNALS),
]

NO_TEXT = ("unknown", "0.00", "No title or context available")
TAIL_RULES = [
    RoleRule("other", "0.80", "Title appears to be non-target role: ",
             True, V.NON_TARGET_TITLES),
    RoleRule("unknown", "0.40", "Weak data-related title signal but no clear role: ",
             True, V.WEAK_DATA_TITLES),
]
NO_SIGNAL = ("other", "0.60", "No target data role signal matched")


def role_texts(title, description, job_function, industries) -> tuple[Column, Column]:
    """Title text, and the context: all non-empty texts joined by a blank."""
    texts = [match_text(F.col(c) if isinstance(c, str) else c)
             for c in (title, description, job_function, industries)]
    context = F.concat_ws(" ", *[F.nullif(t, F.lit("")) for t in texts])
    return texts[0], context


def with_role_texts(df: DataFrame) -> DataFrame:
    title, context = role_texts("job_title", "description_text", "job_function", "industries")
    return df.withColumns({"_title": title, "_context": context})


def _tagged(number: int, reason: Column) -> Column:
    return F.concat(F.lit(f"{number:02d}\t"), reason)


def with_detected_role(
    df: DataFrame,
    rules: Sequence[RoleRule] = tuple(ROLE_RULES),
    tail: Sequence[RoleRule] = tuple(TAIL_RULES),
) -> DataFrame:
    """Add detected_role, role_confidence and role_reason from _title and _context."""
    title, context = F.col("_title"), F.col("_context")
    index = rule_phrases([*rules, *tail])
    read = with_computed(df, {
        "_in_title": index.found(title), "_in_context": index.found(context),
    })
    texts = RuleTexts(index, F.col("_in_title"), F.col("_in_context"))
    outcomes: list[tuple[str, str]] = []
    chain: list[Column] = []

    def add(role: str, confidence: str, reason: Column) -> None:
        chain.append(_tagged(len(outcomes), reason))
        outcomes.append((role, confidence))

    for number, rule in enumerate(rules):
        add(rule.role, rule.confidence, rule.explain(number, texts))
    no_text = (title == "") & (context == "")
    add(NO_TEXT[0], NO_TEXT[1], F.when(no_text, F.lit(NO_TEXT[2])))
    for number, rule in enumerate(tail, len(rules)):
        add(rule.role, rule.confidence, rule.explain(number, texts))
    add(NO_SIGNAL[0], NO_SIGNAL[1], F.lit(NO_SIGNAL[2]))

    ids = [f"{n:02d}" for n in range(len(outcomes))]
    roles = literal_map({i: o[0] for i, o in zip(ids, outcomes)})
    scores = literal_map({i: o[1] for i, o in zip(ids, outcomes)})
    hit = with_computed(read, {"_hit": F.coalesce(*chain)})
    rule_id = F.substring("_hit", 1, 2)
    return hit.withColumns(
        {
            "detected_role": F.try_element_at(roles, rule_id),
            "role_confidence": F.try_element_at(scores, rule_id).cast("decimal(5,2)"),
            "role_reason": F.expr("substring(_hit, 4)"),
        }
    ).drop("_hit", "_in_title", "_in_context")


def exclusion_reason(title_text: Column, words: Sequence[str] = tuple(V.EXCLUSION_WORDS)) -> Column:
    return F.concat(F.lit(V.EXCLUSION_REASON), first_phrase(title_text, words))


SENIORITY_INDEX = PhraseIndex(V.SENIORITY_KEYWORDS)


def seniority(found: Column) -> Column:
    """First class, in listed order, with a keyword in the text; `found` is what
    SENIORITY_INDEX finds there."""
    tests = [
        F.when(SENIORITY_INDEX.has(found, name), F.lit(name)) for name in V.SENIORITY_KEYWORDS
    ]
    return F.coalesce(*tests, F.lit(V.SENIORITY_UNKNOWN))


def role_label(role: Column) -> Column:
    return F.coalesce(F.initcap(F.replace(role, F.lit("_"), F.lit(" "))), F.lit("Unknown"))
