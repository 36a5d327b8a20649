"""Running streaming queries to the end of what is available."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def run_to_end(
    writer: DataStreamWriter, target: str | None = None, wait: bool = True
) -> StreamingQuery:
    """Processes everything available, then stops; raises what the query raised.

    Without ``wait`` the query is only started, to be passed to ``await_all`` with others.
    """
    writer = writer.trigger(availableNow=True)
    query = writer.toTable(target) if target else writer.start()
    if wait:
        query.awaitTermination()
    return query


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Waits for every query, not only for the first one that ends; then raises the first error."""
    errors = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            errors.append(error)
    if errors:
        raise errors[0]
