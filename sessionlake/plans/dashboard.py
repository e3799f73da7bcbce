"""The four tiles of the session dashboard."""

from __future__ import annotations

from sessionlake.plans.semantic import Not, Tile

# Row limits and highlight thresholds of the tiles.
CITY_LIMIT = 10
COUNTRY_LIMIT = 10
REFERRER_LIMIT = 5
PAGE_HIT_LIMIT = 500
SESSION_HIGHLIGHT = 10000
PAGE_HIT_HIGHLIGHT = 20000


def top_cities(country: str = "United States", month: str = "June") -> Tile:
    """Cities of one country by sessions in a month."""
    return Tile(
        by=["geo_network.city"],
        limit=CITY_LIMIT,
        filters={"date.month_name": month, "geo_network.country": country},
    )


def top_countries(without: str = "United States", month: str = "June") -> Tile:
    """Countries but one by sessions in a month."""
    return Tile(
        by=["geo_network.country"],
        limit=COUNTRY_LIMIT,
        filters={"date.month_name": month, "geo_network.country": Not(without)},
    )


def top_referrers(year: int = 2017) -> Tile:
    """Traffic sources by sessions in a year."""
    return Tile(by=["traffic_source.source"], limit=REFERRER_LIMIT, filters={"date.year": year})


def page_hits(year: int = 2017) -> Tile:
    """Visitors by type of their entrance hit in a year."""
    return Tile(
        by=["hits.is_entrance", "hits.type"],
        limit=PAGE_HIT_LIMIT,
        filters={"date.year": year, "hits.is_entrance": True},
    )
