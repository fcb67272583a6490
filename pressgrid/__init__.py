"""News-coverage analytics as Spark DataFrame operations."""

from pressgrid.operators.articles import match_articles, match_terms, normalize_articles
from pressgrid.operators.dedup import dedup_articles, dedup_counts, sort_articles, union_fetches
from pressgrid.operators.pages import (
    enrich_articles,
    enrichment_errors,
    enrichment_summary,
    extract_pages,
)
from pressgrid.operators.predicates import article_predicate, in_range, select_articles
from pressgrid.operators.quality import quality_summary, violations
from pressgrid.operators.series import (
    entity_tracking,
    normalize_timeline,
    rebucket,
    sentiment_series,
    tone_timeline,
    trend_series,
    volume_series,
    volume_timeline,
)
from pressgrid.operators.summary import analysis_targets, dataset_summary, ranked_counts, rankings
from pressgrid.operators.windows import (
    adaptive_windows,
    assign_windows,
    cap_per_window,
    collect_articles,
    coverage_summary,
    coverage_warnings,
    fixed_windows,
    window_tree,
)
from pressgrid.plans.dataset import Dataset, build_dataset
from pressgrid.plans.request import Filters, Near, Request, Sort, TimeRange
from pressgrid.sources import (
    flatten_articles,
    land_articles,
    read_articles,
    read_corpus,
    read_pages,
    read_timeline,
    write_articles_csv,
    write_sections,
)

__all__ = [
    "Dataset", "Filters", "Near", "Request", "Sort", "TimeRange", "adaptive_windows", "analysis_targets",
    "article_predicate", "assign_windows", "build_dataset", "cap_per_window", "collect_articles",
    "coverage_summary", "coverage_warnings", "dataset_summary", "dedup_articles", "dedup_counts",
    "enrich_articles", "enrichment_errors", "enrichment_summary", "entity_tracking", "extract_pages",
    "fixed_windows", "flatten_articles", "in_range", "land_articles", "match_articles", "match_terms",
    "normalize_articles", "normalize_timeline", "quality_summary", "ranked_counts", "rankings",
    "read_articles", "read_corpus", "read_pages", "read_timeline", "rebucket", "select_articles",
    "sentiment_series", "sort_articles", "tone_timeline", "trend_series", "union_fetches", "violations",
    "volume_series", "volume_timeline", "window_tree", "write_articles_csv", "write_sections",
]
