"""Plug-ins: an issuer may have an extractor of its own, a function from pages to v1 records."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Extractor = Callable[[DataFrame], DataFrame]
log = logging.getLogger(__name__)


@dataclass
class Registry:
    extractors: dict[str, Extractor] = field(default_factory=dict)
    skips: dict[str, Callable[[Column], Column]] = field(default_factory=dict)

    def register(self, issuer_ids: list[str], extractor: Extractor, skip_url: Callable[[Column], Column] | None = None) -> None:
        """The last registration of an issuer counts."""
        for issuer in issuer_ids:
            if issuer in self.extractors:
                log.warning("issuer %s has a new extractor", issuer)
            self.extractors[issuer] = extractor
            if skip_url:
                self.skips[issuer] = skip_url

    def wanted(self, frontier: DataFrame, url: str = "url") -> DataFrame:
        """Frontier rows that no plug-in of their issuer skips."""
        skip = F.lit(False)
        for issuer, test in self.skips.items():
            skip = skip | F.coalesce((F.col("issuer_id") == issuer) & test(F.col(url)), F.lit(False))
        return frontier.where(~skip | F.col("force_card_name").isNotNull()) if "force_card_name" in frontier.columns else frontier.where(~skip)

    def extract(self, pages: DataFrame, default: Extractor) -> DataFrame:
        """Each issuer's pages by its extractor, all others by the default, as one relation."""
        groups: dict[Extractor, list[str]] = {}
        for issuer, extractor in self.extractors.items():
            groups.setdefault(extractor, []).append(issuer)
        known = list(self.extractors)
        out = default(pages.where(F.col("issuer_id").isNull() | ~F.col("issuer_id").isin(*known)) if known else pages)
        for extractor, issuers in groups.items():
            out = out.unionByName(extractor(pages.where(F.col("issuer_id").isin(*issuers))), allowMissingColumns=True)
        return out
