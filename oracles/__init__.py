"""DuckDB statements that compute every catalog query independently, over whole tables."""

from __future__ import annotations

from oracles.blocks import statement
from oracles.cleaning import CLEANING
from oracles.facts import FACTS
from oracles.forecasting import FORECASTING
from oracles.publishing import PUBLISHING

ORACLES: dict[str, str] = {
    name: statement(sql) for part in (FACTS, CLEANING, FORECASTING, PUBLISHING) for name, sql in part.items()
}
