"""Marketing and device attributes of a page view."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utm_param(page_url: Column, name: str) -> Column:
    """Value of ``utm_<name>``; '' where the parameter is missing."""
    return F.regexp_extract(page_url, f"utm_{name}=([^&]+)", 1)


# Search engines named in a referrer.
SEARCH_ENGINES = ("google", "bing", "yahoo")


def channel_group(page_url: Column, referrer: Column) -> Column:
    engine = F.lower(referrer)
    organic = F.contains(engine, F.lit(SEARCH_ENGINES[0]))
    for name in SEARCH_ENGINES[1:]:
        organic = organic | F.contains(engine, F.lit(name))
    # '_' is a LIKE wildcard: any character after 'utm' counts
    return (
        F.when(page_url.like("%utm_%"), "Paid")
        .when(referrer.isNull() | (referrer == ""), "Direct")
        .when(organic, "Organic Search")
        .otherwise("Referral")
    )


def _has(agent: Column, word: str) -> Column:
    return agent.ilike(f"%{word}%")


def platform(agent: Column) -> Column:
    tablet = _has(agent, "ipad") | _has(agent, "tablet")
    return (
        F.when(tablet, "Tablet").when(_has(agent, "mobile"), "Mobile").otherwise("Desktop")
    )


# Agent words and their operating system, first hit wins.
OS_WORDS = (
    ("android", "Android"),
    ("iphone", "iOS"),
    ("ipad", "iOS"),
    ("mac os", "MacOS"),
    ("windows", "Windows"),
    ("linux", "Linux"),
)


def operating_system(agent: Column) -> Column:
    chain = F
    for word, label in OS_WORDS:
        chain = chain.when(_has(agent, word), label)
    return chain.otherwise("Other/Unknown")


def browser(agent: Column) -> Column:
    chrome, edge = _has(agent, "chrome"), _has(agent, "edg")
    return (
        F.when(chrome & ~edge, "Chrome")
        .when(_has(agent, "safari") & ~chrome & ~_has(agent, "android"), "Safari")
        .when(_has(agent, "firefox"), "Firefox")
        .when(edge, "Edge")
        .otherwise("Other")
    )
