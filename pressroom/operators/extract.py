"""Article extraction: pages joined to their rules, everything else inside the page row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.functions.text import blank_to_null, clean_text
from pressroom.functions.urls import let
from pressroom.operators import dom
from pressroom.operators.quality import quality_flags
from pressroom.schemas import ARTICLES
from pressroom.session import bounded_broadcast

SCALAR_FIELDS = ["title", "author", "published_at", "thumbnail_url"]
CONTENT = "content_paragraphs"
STRIP = "strip"
GENERIC_RULE_SET = "generic"

# JSON-LD types that describe an article.
ARTICLE_TYPES = ["newsarticle", "article", "reportagereport"]

# Block elements considered as main-text containers.
CONTAINERS = ["article", "main", "section", "div", "td", "body"]


def rule_sets(source_rules: DataFrame) -> DataFrame:
    """One row per source: its rules as an ordered array, selectors already split into steps.

    The array is bounded by a source's configuration, not by data.
    """
    selector = F.substring_index("selector", "@", 1)
    # Only the first '@' separates selector and attribute.
    attribute = F.when(F.instr("selector", "@") > 0, F.trim(F.regexp_replace("selector", r"(?s)^[^@]*@", "")))
    rule = F.struct(
        F.col("field"), F.col("priority"), attribute.alias("attr"), dom.selector_steps(F.trim(selector)).alias("steps")
    )
    return source_rules.groupBy(F.lower("source_name").alias("rule_set")).agg(
        F.sort_array(F.collect_list(F.struct("field", "priority", rule.alias("rule")))).alias("packed")
    ).select("rule_set", F.transform("packed", lambda p: p["rule"]).alias("rules"))


def _rule_value(nodes: Column, match: Column) -> Column:
    """Value of a rule: text of the first match, or an attribute of the first match and of no other."""

    def value(hit: Column) -> Column:
        attr = F.try_element_at(dom.node_at(nodes, hit["pos"])["attrs"], F.lower(match["attr"]))
        return F.when(match["attr"].isNull(), dom.element_text(nodes, hit)).otherwise(clean_text(attr))

    return F.when(F.size(match["hits"]) > 0, let(dom.first_or_null(match["hits"]), value))


def _cascade(values: Column, field: str) -> Column:
    """First non-empty value of a field, in rule priority."""
    hits = F.filter(values, lambda v: (v["field"] == field) & v["value"].isNotNull())
    return dom.first_or_null(hits)["value"]


def _text_field(item: Column, key: str) -> Column:
    value = F.try_variant_get(item, f'$["{key}"]', "variant")
    return F.when(F.schema_of_variant(value) == "STRING", clean_text(F.try_variant_get(value, "$", "string")))


def _text_of_shape(item: Column, key: str, inner: str, first_of_objects: bool) -> Column:
    """A value that may be a text, an object holding the text, or a list of either; lists count by their first item."""
    value = F.try_variant_get(item, f'$["{key}"]', "variant")
    first = F.try_variant_get(value, "$[0]", "variant")
    options = [_text_field(item, key), _text_field(value, inner), F.when(
        F.schema_of_variant(first) == "STRING", clean_text(F.try_variant_get(first, "$", "string")))]
    if first_of_objects:
        options.append(_text_field(first, inner))
    return F.coalesce(*options)


def jsonld_article(page: Column) -> Column:
    """Struct of the first non-empty headline, date, image and author over all article items of a page."""
    nodes = page["nodes"]
    scripts = F.filter(
        dom.nodes_of(page, "script"),
        lambda n: (F.lower(F.coalesce(F.try_element_at(n["attrs"], F.lit("type")), F.lit(""))) == "application/ld+json"),
    )

    def items(script: Column) -> Column:
        body = F.array_join(F.transform(F.filter(dom.subtree(nodes, script), lambda n: n["tag"] == dom.CODE), lambda n: n["text"]), "")
        return let(
            F.try_parse_json(body),
            lambda doc: F.coalesce(
                F.try_variant_get(doc, "$", "array<variant>"),
                F.try_variant_get(doc, '$["@graph"]', "array<variant>"),
                F.when(F.schema_of_variant(doc).startswith("OBJECT"), F.array(doc)),
                F.array().cast("array<variant>"),
            ),
        )

    fields = F.transform(
        F.filter(
            F.flatten(F.transform(scripts, items)),
            lambda i: F.lower(_text_field(i, "@type")).isin(ARTICLE_TYPES),
        ),
        lambda i: F.struct(
            _text_field(i, "headline").alias("title"),
            _text_of_shape(i, "author", "name", True).alias("author"),
            _text_field(i, "datePublished").alias("published_at"),
            _text_of_shape(i, "image", "url", False).alias("thumbnail_url"),
        ),
    )

    def first(found: Column, name: str) -> Column:
        return dom.first_or_null(F.filter(F.transform(found, lambda x: x[name]), lambda x: x.isNotNull())).alias(name)

    return F.when(
        F.size(scripts) > 0, let(fields, lambda found: F.struct(*[first(found, f) for f in SCALAR_FIELDS]))
    )


def content_paragraphs(nodes: Column, matches: Column, stripped: Column) -> Column:
    """Cleaned paragraphs of the selector with the most surviving nodes; blank nodes count, first wins on ties."""
    candidates = F.transform(
        F.filter(matches, lambda m: m["field"] == CONTENT),
        lambda m: F.filter(m["hits"], lambda h: ~dom.inside_any(h["pos"], stripped)),
    )
    best = F.aggregate(
        candidates,
        F.array().cast(dom.RANGES),
        lambda acc, hits: F.when(F.size(hits) > F.size(acc), hits).otherwise(acc),
    )
    texts = F.transform(best, lambda h: dom.element_text(nodes, h, stripped))
    return F.filter(texts, lambda t: t.isNotNull())


def main_text(page: Column) -> Column:
    """Text of the densest container: much own text, few links, little around it. Any text counts, however short.

    A container scores its plain text discounted by the share of links and peripheral text in it, so a tight container beats the
    page around it. Scores are differences of running totals that the tokeniser kept; text is put together for the best one only.
    """
    nodes = page["nodes"]

    def scored(c: Column) -> Column:
        end = F.get(nodes, c["last"])
        plain, total = (end["plain"] - c["plain"]).cast("double"), (end["chars"] - c["chars"]).cast("double")
        score = plain * plain / F.greatest(total, F.lit(1.0))
        return F.struct(score.alias("score"), c["pos"].alias("pos"), c["last"].alias("last"), plain.alias("plain"))

    def text(best: Column) -> Column:
        inside = F.slice(nodes, best["pos"] + 1, best["last"] - best["pos"] + 1)
        own = F.filter(inside, lambda n: (n["tag"] == dom.TEXT) & ~n["aside"])
        return F.when(best["plain"] > 0, clean_text(F.array_join(F.transform(own, lambda n: n["text"]), " ")))

    return let(F.array_max(F.transform(dom.nodes_of(page, *CONTAINERS), scored)), text)


def canonical_link(page: Column, stripped: Column) -> Column:
    links = F.filter(
        dom.nodes_of(page, "link"),
        lambda n: F.coalesce(F.lower(F.try_element_at(n["attrs"], F.lit("rel"))).contains("canonical"), F.lit(False))
        & ~dom.inside_any(n["pos"], stripped),
    )
    return clean_text(F.try_element_at(dom.first_or_null(links)["attrs"], F.lit("href")))


def with_rules(pages: DataFrame, source_rules: DataFrame, rule_set: str = "rule_set") -> DataFrame:
    """Attach each page's rules; unknown rule sets get none."""
    rules = bounded_broadcast(rule_sets(source_rules).withColumnRenamed("rule_set", "_rule_set"))
    return pages.join(rules, F.col(rule_set) == F.col("_rule_set"), "left").drop("_rule_set")


def extract_articles(
    pages: DataFrame,
    source_rules: DataFrame,
    rule_set: str = "rule_set",
    html: str = "html",
    use_jsonld: bool = True,
    use_main_text: bool = True,
) -> DataFrame:
    """Article fields and quality flags per page; all other page columns except the HTML are kept.

    Blank pages pass through with null fields. Quality flags are set before any discovery fallback.
    """
    with_rule_rows = with_rules(pages, source_rules, rule_set)
    kept = [c for c in pages.columns if c != html]
    staged = with_rule_rows.select(*kept, "rules", dom.parse_page(html).alias("_page"))
    page, nodes = F.col("_page"), F.col("_page.nodes")
    matched = staged.withColumn(
        "_matches",
        F.transform(
            F.coalesce("rules", F.array().cast(staged.schema["rules"].dataType)),
            lambda r: F.struct(r["field"].alias("field"), r["attr"].alias("attr"), dom.select_all(page, r["steps"]).alias("hits")),
        ),
    )
    no_ranges = F.array().cast(dom.RANGES)
    fields = matched.select(
        *kept,
        "_page",
        "_matches",
        F.coalesce(
            F.flatten(F.transform(F.filter("_matches", lambda m: m["field"] == STRIP), lambda m: m["hits"])), no_ranges
        ).alias("_stripped"),
        F.transform(
            F.filter("_matches", lambda m: m["field"].isin(SCALAR_FIELDS)),
            lambda m: F.struct(m["field"].alias("field"), _rule_value(nodes, m).alias("value")),
        ).alias("_values"),
        (jsonld_article(page) if use_jsonld else F.lit(None).cast(
            "struct<title:string,author:string,published_at:string,thumbnail_url:string>")).alias("_jsonld"),
    )
    stripped = F.col("_stripped")
    articles = fields.select(
        *kept,
        "_page",
        *[F.coalesce(_cascade(F.col("_values"), f), F.col("_jsonld")[f]).alias(f) for f in SCALAR_FIELDS],
        content_paragraphs(nodes, F.col("_matches"), stripped).alias("_paragraphs"),
        canonical_link(page, stripped).alias("canonical_url"),
    )
    from_rules = blank_to_null(F.array_join("_paragraphs", "\n\n"))
    fallback = main_text(page) if use_main_text else F.lit(None).cast("string")
    final = articles.select(
        *kept,
        *SCALAR_FIELDS,
        F.coalesce(from_rules, F.when(F.size("_paragraphs") == 0, fallback)).alias("content"),
        F.coalesce(F.size("_paragraphs"), F.lit(0)).cast("bigint").alias("paragraph_count"),
        "canonical_url",
    )
    return final.withColumn("quality_flags", quality_flags())


def custom_articles(pages: DataFrame, parser: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], html: str = "html") -> DataFrame:
    """Articles from a parser of one's own, for sources that no rule set fits.

    ``parser`` maps batches of ``url, html`` to batches in the columns of ``schemas.ARTICLES``.
    """
    return pages.select("url", F.col(html).alias("html")).mapInPandas(parser, ARTICLES)


def merge_discovery(articles: DataFrame, discovered: DataFrame, on: list[str] | str = "url") -> DataFrame:
    """Fill missing title, date, author and thumbnail from discovery; of several hints for a key the smallest value counts."""
    keys = [on] if isinstance(on, str) else on
    hints = discovered.groupBy(*keys).agg(*[F.min(blank_to_null(f)).alias(f"_hint_{f}") for f in SCALAR_FIELDS])
    joined = articles.join(hints, keys, "left")
    filled = {f: F.coalesce(blank_to_null(f), blank_to_null(f"_hint_{f}")) for f in SCALAR_FIELDS}
    return joined.withColumns(filled).drop(*[f"_hint_{f}" for f in SCALAR_FIELDS])
