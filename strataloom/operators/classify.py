"""Rule cascades as ordered conditions; rule tables are parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import fixed, text


def topic_keywords(content: Column, topics: dict[str, list[str]] = fixed.TOPICS) -> Column:
    """Keywords of all topics that the text holds, by their place in the topics' lists one after the other."""
    return text.found_keywords(content, [w for words in topics.values() for w in words])


def topic_hits(found: Column, topics: dict[str, list[str]] = fixed.TOPICS) -> dict[str, Column]:
    """How many of the keywords ``found`` each topic has."""

    def between(a: int, b: int) -> Column:
        return F.size(F.filter(found, lambda i: (i >= a) & (i < b)))

    out, begin = {}, 0
    for name, words in topics.items():
        out[name] = between(begin, begin + len(words))
        begin += len(words)
    return out


def best_topic(hits: dict[str, Column]) -> tuple[Column, Column]:
    """(topic with most hits, hits); the first in order on a tie, null without any."""
    most = F.greatest(*hits.values()) if len(hits) > 1 else next(iter(hits.values()))
    topic = F.lit(None).cast("string")
    for name, n in reversed(hits.items()):
        topic = F.when((n == most) & (most > 0), F.lit(name)).otherwise(topic)
    return topic, most


def default_topic(category: Column, table: dict[str, str] = fixed.DEFAULT_TOPICS, fallback: str = fixed.FALLBACK_TOPIC) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce(category, F.lit(""))), F.lit(fallback))


def _driving_rule() -> str:
    names = "|".join(name.replace(" ", r"\s+") for name in fixed.DRIVING_RULES)
    return rf"(?iU)điều\s+\d+\.\s*({names})"


def chunk_verdict(content: Column, heading_path: Column, category: Column, topics: dict[str, list[str]] = fixed.TOPICS, core: list[str] = fixed.CORE_CATEGORIES, excluded: list[str] = fixed.EXCLUDED_TITLES, min_score: float = 0.5) -> Column:
    """struct(admitted, topic, score, reason); the first rule that applies decides."""
    top = F.coalesce(F.get(heading_path, F.lit(0)), F.lit(""))
    title, body = F.lower(top), F.lower(content)
    why = fixed.REASONS
    out = lambda admitted, topic, score, reason: F.struct(F.lit(admitted).alias("admitted"), topic.cast("string").alias("topic"), score.cast("double").alias("score"), reason.alias("reason"))
    no = lambda reason: out(False, F.lit(None), F.lit(0.0), reason if isinstance(reason, Column) else F.lit(reason))

    def judge(best: Column) -> Column:
        topic, hits = best["topic"], best["hits"]
        score = F.round(F.least(F.lit(1.0), 0.5 + hits * 0.1), 2)
        return (
            F.when(text.contains_any(title, excluded), no(F.concat(F.lit(why["excluded"]), top)))
            .when(body.rlike(_driving_rule()), no(why["driving"]))
            .when(F.contains(title, F.lit(fixed.INSURANCE_TITLE)) & ~text.contains_any(body, fixed.INSURANCE_WORDS), no(why["insurance"]))
            .when(F.contains(body, F.lit("about: blank")) & (F.length(text.strip(body)) < 100), no(why["noise"]))
            .when(category.isin(core), out(True, F.coalesce(topic, default_topic(category)), F.lit(0.95), F.lit(why["core"])))
            .when((hits > 0) & (score >= min_score), out(True, topic, score, F.lit(why["topic"])))
            .otherwise(no(why["none"]))
        )

    def counted(found: Column) -> Column:
        """The best topic, told from the counts once."""
        hits = topic_hits(found, topics)
        return text.bind(F.struct(*(n.alias(f"n{i}") for i, n in enumerate(hits.values()))), lambda n: named({t: n[f"n{i}"] for i, t in enumerate(hits)}))

    def named(hits: dict[str, Column]) -> Column:
        topic, most = best_topic(hits)
        return text.bind(F.struct(topic.alias("topic"), most.alias("hits")), judge)

    return text.bind(topic_keywords(body, topics), counted)


def document_verdict(title: Column, source_id: Column, category: Column, core: list[str] = fixed.CORE_CATEGORIES, excluded: list[str] = fixed.EXCLUDED_TITLES) -> Column:
    """struct(admitted, topic, score, reason) of a document as a whole."""
    t, s = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(source_id, F.lit("")))
    out_of = text.contains_any(t, excluded) | text.contains_any(s, [x.replace(" ", "_") for x in excluded])
    why = fixed.REASONS
    row = lambda a, topic, score, reason: F.struct(F.lit(a).alias("admitted"), topic.cast("string").alias("topic"), F.lit(score).alias("score"), reason.alias("reason"))
    return (
        F.when(out_of, row(False, F.lit(None), 0.0, F.concat(F.lit(why["excluded"]), F.coalesce(title, F.lit("")))))
        .when(category.isin(core), row(True, default_topic(category), 1.0, F.lit(why["core"])))
        .when(text.contains_any(t, fixed.LEGAL_TITLE_WORDS), row(True, F.lit(fixed.LEGAL_TOPIC), 0.9, F.lit(why["legal_document"])))
        .otherwise(row(False, F.lit(None), 0.0, F.lit(why["other_document"])))
    )


def url_is_valid(title: Column, url: Column, category: Column, official: str | None = None, two_wheelers: list[str] = fixed.TWO_WHEELERS) -> Column:
    """Whether an entry of an address list is of use. ``official``: part of the
    address that entries with specifications must have (no such rule if None)."""
    t, u = F.lower(title), F.lower(url)
    bad = text.contains_any(t, two_wheelers) | text.contains_any(u, two_wheelers) | text.contains_any(u, fixed.LAW_PORTALS + fixed.LAW_PATHS)
    bad = bad | (category == fixed.PRICE_CATEGORY)
    if official is not None:
        bad = bad | ((category == fixed.SPEC_CATEGORY) & ~F.contains(u, F.lit(official)))
    given = (F.coalesce(url, F.lit("")) != "") & (F.coalesce(title, F.lit("")) != "")
    return given & ~F.coalesce(bad, F.lit(False))
