"""Pages and reports of landed files stay small however many rows there are."""

import pytest
from pyspark.sql import functions as F

from regwatch.plans import io_queries as io

ROWS = 40_000


@pytest.mark.parametrize(
    ("made", "column", "table"),
    [
        (io.company_pages, "items", "lpad(cast(id as string), 8, '0') as company_number, 'x' as company_name, date '2024-01-01' as date_of_creation, 'y' as address_line_1, 'z' as postcode"),
        (io.lookup_pages, "establishments", "id as entity_id, 'z' as post_code"),
        (io.auth_reports, "record", "'10.0.0.1' as source_ip, 1L as count, 'none' as disposition, 'pass' as dkim, 'fail' as spf, 'a.b' as header_from, 'r' as reporter, date '2024-01-01' as begin_, date '2024-01-02' as end_"),
    ],
)
def test_pages_are_bounded_and_whole(spark, made, column, table):
    rows = spark.sql(f"select {table} from range({ROWS})")
    total, most = made(lambda _: rows).agg(F.sum(F.size(column)), F.max(F.size(column))).first()
    assert total == ROWS and most <= 1.3 * io.PAGE
    assert made(lambda _: rows.limit(0)).count() == 0
