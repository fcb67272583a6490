"""Articles in their final shape, and the terms they mention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgrid.functions.text import blank_to_null, clean, fold, let, strip
from pressgrid.functions.times import seen_timestamp
from pressgrid.operators.predicates import match_space
from pressgrid.schemas import ARTICLE, SCRAPED
from pressgrid.sources.staging import STAGES, Stages

#: Longest pieces of text by which terms of a table are found, and how much of a word is cut up at once.
_GRAM, _CHUNK = 3, 64
#: Lengths of the runs by which a table of terms that every task holds is looked up, the largest that fits a term, and how
#: many characters of a text are cut into them at once.
_RUNS, _PIECE = (1, 2, 3, 5), 1 << 16
#: Bytes of such a table at most, and bytes that a term takes there besides its letters.
_HELD, _ROW = 16 << 20, 64


def _scraped_columns(articles: DataFrame) -> dict[str, Column]:
    """The fields of the nested page result; null where the input does not have them."""
    kind = dict(articles.dtypes).get("scraped", "")
    present = articles.schema["scraped"].dataType.fieldNames() if kind.startswith("struct") else ()
    return {
        field.name: F.col(f"scraped.{field.name}") if field.name in present else F.lit(None).cast(field.dataType)
        for field in SCRAPED
    }


def article_space(articles: DataFrame) -> Column:
    """The text in which terms are looked for: listing first, then the page. Domain and country enter
    as they are, the rest stripped; a term may span two of them."""
    page = _scraped_columns(articles)
    return match_space([
        strip(F.col("title")), F.col("domain"), F.col("sourcecountry"),
        strip(page["title"]), strip(page["description"]), strip(page["text"]),
    ])


def _wanted(terms: Sequence[str]) -> list[str]:
    return [term.strip() for term in terms if term and term.strip()]


def _hits(folded: Column, terms: list[str]) -> Column:
    if not terms:
        return F.array().cast("array<string>")
    pairs = F.array(*(F.struct(F.lit(t).alias("term"), F.lit(t.casefold()).alias("folded")) for t in terms))
    return F.transform(
        F.filter(pairs, lambda pair: F.contains(folded, pair["folded"])), lambda pair: pair["term"]
    )


def match_terms(space: Column, terms: Sequence[str]) -> Column:
    """Those of ``terms`` that the text contains regardless of case, in the given order, repeats kept."""
    wanted = _wanted(terms)
    return let(fold(space), lambda text: _hits(text, wanted)) if wanted else _hits(space, wanted)


def _grams(word: Column, size: Column) -> Column:
    """All runs of ``size`` characters, each once; none of a shorter word."""
    starts = F.when(F.length(word) >= size, F.sequence(F.lit(1), F.length(word) - size + 1))
    runs = F.transform(starts, lambda at: F.substring(word, at, size))
    return F.coalesce(F.array_distinct(runs), F.array().cast("array<string>"))


def _chunks(word: Column) -> Column:
    """Overlapping stretches of a word that together hold all its runs of up to ``_GRAM`` characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1)), F.lit(_CHUNK))
    return F.transform(starts, lambda at: F.substring(word, at, F.lit(_CHUNK + _GRAM - 1)))


def _runs(text: Column) -> Column:
    """All runs of ``_RUNS`` characters, each once; no more than those of a piece are held besides the different ones."""
    def cut(piece: Column) -> Column:
        return F.flatten(F.array(*(F.regexp_extract_all(piece, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1)) for n in _RUNS)))

    over = _PIECE + max(_RUNS) - 1
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{over}}})).{{1,{_PIECE}}}"), F.lit(1))
    return F.aggregate(pieces, F.array().cast("array<string>"), lambda done, piece: F.array_union(done, cut(piece)))


def _folded(terms: DataFrame, term: str) -> DataFrame:
    """(term, folded) of each term, once; null and empty ones are left out."""
    named = terms.select(blank_to_null(strip(F.col(term))).alias("term"))
    return named.filter(F.col("term").isNotNull()).distinct().withColumn("folded", fold(F.col("term")))


def _looked_up(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_id, term) of the texts, each looked through by the task that holds it.

    A term stands under one of its runs, that which it shares with the fewest others, and a text has each run once, so a term is
    met once in a text and nothing has to be gathered afterwards. The texts are dealt out before: looking up takes far
    longer than reading, so parts of a size that suits a scan would keep few tasks busy.
    """
    size = F.greatest(*(F.when(F.length("folded") >= n, n) for n in _RUNS))
    runs = wanted.select("*", F.explode(_grams(F.col("folded"), size)).alias("gram"))
    shared = runs.groupBy("gram").agg(F.count("*").alias("terms"))
    listed = runs.join(shared, "gram").groupBy("term", "folded").agg(F.min(F.struct("terms", "gram"))["gram"].alias("gram"))
    cut = texts.select("_id", "_text", F.explode(_runs(F.col("_text"))).alias("gram"))
    return cut.join(F.broadcast(listed), "gram").filter(F.contains("_text", "folded")).select("_id", "term")


def _anchored(wanted: DataFrame) -> DataFrame:
    """(term, folded, anchor, led, followed, single) of each term: its longest word, and whether words stand beside it."""
    words = F.split("folded", " ")
    longest = F.array_max(F.transform(words, lambda word, at: F.struct(
        F.length(word).alias("size"), (-at).alias("before"), word.alias("word")
    )))
    last = F.size(words) - 1
    return (
        wanted.withColumn("longest", longest)
        .select(
            "term", "folded", F.col("longest.word").alias("anchor"),
            (F.col("longest.before") < 0).alias("led"), (F.col("longest.before") > -last).alias("followed"),
            (last == 0).alias("single"),
        )
    )


def _indexed(texts: DataFrame, wanted: DataFrame, stages: Stages) -> DataFrame:
    """(_id, term) of the texts, for more terms than a task may hold.

    A term is looked up by its longest word, and that by its rarest run of up to three characters, in an inverted index of the
    words that the texts are made of. Only words that share this run are compared with it, once for the whole table however often
    they occur. Terms of one word are settled by that; a text is searched for a longer term only if it has a word that
    the term's longest one fits.
    """
    wanted = _anchored(wanted)
    words = texts.select("_id", F.explode(F.array_distinct(F.split("_text", " "))).alias("word")).filter("word <> ''")
    vocabulary = stages.keep(words.select("word").distinct(), "vocabulary")
    sizes = range(1, _GRAM + 1)
    index = (
        vocabulary.select("word", F.explode(_chunks(F.col("word"))).alias("part"))
        .select("word", F.explode(F.flatten(F.array(*(_grams(F.col("part"), F.lit(n)) for n in sizes)))).alias("gram")).distinct()
    )
    counts = index.groupBy("gram").agg(F.count("*").alias("words"))
    own = F.least(F.length("anchor"), F.lit(_GRAM))
    rarest = (
        wanted.select("*", F.explode(_grams(F.col("anchor"), own)).alias("gram")).join(counts, "gram", "left")
        .groupBy("term", "folded", "anchor", "led", "followed", "single")
        .agg(F.min(F.struct(F.coalesce("words", F.lit(0)).alias("words"), F.col("gram"))).alias("rarest"))
        .select("term", "folded", "anchor", "led", "followed", "single", F.col("rarest.gram").alias("gram"))
    )
    word, anchor = F.col("word"), F.col("anchor")
    # A word led by another stands behind a space, so a word of the text begins with it; likewise at its end.
    fits = (
        F.when(F.col("led") & F.col("followed"), word == anchor)
        .when(F.col("led"), F.startswith(word, anchor)).when(F.col("followed"), F.endswith(word, anchor))
        .otherwise(F.contains(word, anchor))
    )
    held = stages.keep(index.join(rarest, "gram").filter(fits).select("word", "term", "folded", "single"), "words")
    single = words.join(held.filter("single").select("word", "term"), "word").select("_id", "term").distinct()
    longer = words.join(held.filter("NOT single").select("word", "term", "folded"), "word")
    asked = longer.groupBy("_id").agg(F.collect_set(F.struct("term", "folded")).alias("_asked"))
    found = F.filter("_asked", lambda term: F.contains(F.col("_text"), term["folded"]))
    several = texts.join(asked, "_id").select("_id", F.explode(found).alias("term")).select("_id", "term.term")
    return single.unionByName(several)


def match_term_table(
    rows: DataFrame, terms: DataFrame, space: Column, id_column: str, term_column: str = "term", stages: Stages = STAGES,
    held_bytes: int = _HELD,
) -> DataFrame:
    """(``id_column``, ``term``) for every row whose text ``space`` contains the term, regardless of case.

    For terms by the thousand, which come as a table; :func:`match_terms` gives the same answer for a few. The terms are measured
    when the operator is called. Up to ``held_bytes`` of them (some 200,000) go to every task, which finds them in its texts by
    runs of a few characters; texts are dealt out once over the session's number of shuffle partitions, matches never. A
    larger table is met by way of an index of the words that the texts consist of, whose shuffles grow with the pairs of a text
    and a term. Null and empty terms are left out, repeated ones count once; a row without text has no matches.
    ``id_column`` identifies a row.
    """
    wanted = stages.keep(_folded(terms, term_column), "terms")
    size = wanted.agg(F.sum(F.octet_length("term") + F.octet_length("folded") + F.lit(_ROW)).alias("bytes")).first()["bytes"]
    texts = rows.select(F.col(id_column).alias("_id"), space.alias("_text"))
    if (size or 0) <= held_bytes:
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = _looked_up(texts.repartition(parts, "_id").withColumn("_text", fold(F.col("_text"))), wanted)
    else:
        found = _indexed(texts.withColumn("_text", fold(F.col("_text"))), wanted, stages)
    return found.withColumnRenamed("_id", id_column)


def match_articles(
    articles: DataFrame, keywords: Sequence[str] = (), phrases: Sequence[str] = (), entities: Sequence[str] = ()
) -> DataFrame:
    """``articles`` with ``matched_keywords`` (keywords, then phrases) and ``matched_entities``.

    Both lists come out of one look at the folded text.
    """
    terms, names = _wanted([*keywords, *phrases]), _wanted(entities)
    space = fold(article_space(articles)) if terms or names else F.lit("")
    both = let(
        space,
        lambda text: F.struct(
            _hits(text, terms).alias("matched_keywords"), _hits(text, names).alias("matched_entities")
        ),
    )
    kept = [c for c in articles.columns if c not in ("matched_keywords", "matched_entities")]
    return articles.withColumn("_hits", both).select(*kept, "_hits.*")


def normalize_articles(
    articles: DataFrame,
    keywords: Sequence[str] = (),
    phrases: Sequence[str] = (),
    entities: Sequence[str] = (),
    themes: Sequence[str] = (),
    strict_dates: bool = True,
) -> DataFrame:
    """Raw articles in the columns of ``schemas.ARTICLE``, followed by any fetch-order columns.

    Texts are stripped and empty ones become null, the id is a hash of the address, and a page that was
    not asked for leaves its defaults.
    """
    page = _scraped_columns(articles)
    url = clean(F.col("url"))
    parsed = seen_timestamp(F.col("seendate"), strict_dates)
    order = [c for c in ("window_index", "position") if c in articles.columns]
    listed = [c for c in articles.columns if c not in (*order, "text", "seen_at", "seen_date")]
    values = {
        "article_id": F.sha2(url, 256),
        "title": clean(F.col("title")),
        "url": url,
        "mobile_url": clean(F.col("url_mobile")),
        "seen_at": F.coalesce(F.col("seen_at"), parsed) if "seen_at" in articles.columns else parsed,
        "domain": clean(F.col("domain")),
        "language": clean(F.col("language")),
        "source_country": clean(F.col("sourcecountry")),
        "social_image_url": clean(F.col("socialimage")),
        "matched_keywords": F.col("matched_keywords"),
        "matched_entities": F.col("matched_entities"),
        "requested_themes": F.array(*map(F.lit, themes)).cast("array<string>"),
        "scrape_status": F.coalesce(clean(page["status"]), F.lit("not_requested")),
        "scrape_success": F.coalesce(page["success"], F.lit(False)),
        "scrape_error": clean(page["error"]),
        "scraped_title": clean(page["title"]),
        "scraped_description": clean(page["description"]),
        "scraped_published_at": clean(page["published_at"]),
        "scraped_language": clean(page["language"]),
        "scraped_final_url": clean(page["final_url"]),
        "scraped_excerpt": clean(page["excerpt"]),
        "scraped_text": clean(page["text"]),
        "scraped_text_length": F.coalesce(page["text_length"], F.lit(0)).cast("long"),
        "raw": F.to_json(F.struct(*listed)),
    }
    matched = match_articles(articles, keywords, phrases, entities)
    return matched.select(*(values[name].alias(name) for name in ARTICLE.fieldNames()), *order)
