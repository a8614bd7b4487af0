"""Row predicates that reports take as parameters."""

from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

# Fixed value: the country choice that stands for no filter.
ALL_COUNTRIES = "All"


@dataclass(frozen=True)
class ReportFilter:
    """Optional date range (ISO days, both included), country and product search.

    Empty values filter nothing. The search text is looked for in the stock
    code and the description, ignoring case; ``%`` and ``_`` in it are
    wildcards.
    """

    start_date: str | None = None
    end_date: str | None = None
    country: str | None = None
    search_query: str | None = None

    def predicate(self) -> Column:
        """All conditions joined by AND, as ranges and equalities a scan can use."""
        conditions = [F.lit(True)]
        if self.start_date:
            start = date.fromisoformat(self.start_date)
            conditions += [
                F.col("invoice_date") >= F.lit(start).cast("timestamp_ntz"),
                F.col("sales_month") >= f"{start:%Y-%m}",
            ]
        if self.end_date:
            end = date.fromisoformat(self.end_date)
            conditions += [
                F.col("invoice_date") < F.lit(end + timedelta(days=1)).cast("timestamp_ntz"),
                F.col("sales_month") <= f"{end:%Y-%m}",
            ]
        if self.country and self.country != ALL_COUNTRIES:
            conditions.append(F.col("country") == self.country)
        return reduce(and_, [*conditions, *self._search()])

    def _search(self) -> list[Column]:
        if not self.search_query or not self.search_query.strip():
            return []
        escaped = self.search_query.strip().replace("\\", "\\\\")
        pattern = f"%{escaped}%"
        return [F.col("stock_code").ilike(pattern) | F.col("description").ilike(pattern)]

    def search_predicate(self) -> Column | None:
        """The condition on stock code and description alone; None without a search text."""
        return next(iter(self._search()), None)

    def without_search(self) -> "ReportFilter":
        """All conditions but the search."""
        return replace(self, search_query=None)


NO_FILTER = ReportFilter()
