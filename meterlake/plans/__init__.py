"""Plan-level building blocks: sessions, value ranges, exact quantiles, scoring chains."""
