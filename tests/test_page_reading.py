"""Pages are parsed only where a query needs it, and few results are held as Python objects."""

import pyarrow as pa

from leadlake.functions import arrow
from leadlake.operators import signals
from leadlake.sources import captures
from pyspark.sql import functions as F


def test_pages_that_can_hold_no_social_link_are_not_parsed(spark):
    hrefs = ["https://www.Instagram.com/a", "https://facebooK.com/b", "https://instagram&period;com/c", "https://f&#97;cebook.com/d", "/menu", "https://x.example.com/?a=1&amp;b=2"]
    pages = spark.createDataFrame([(i, f'<p>x</p><a href="{h}">y</a>') for i, h in enumerate(hrefs)] + [(9, None)], "page_id int, html string")
    whole = signals.with_social_links(captures.with_page_parts(pages)).select("page_id", "page_instagram", "page_facebook")
    read = pages.withColumn("_read", F.when(signals.may_link_socially(F.col("html")), F.col("html")))
    some = captures.with_page_parts(read, "_read")
    assert {r.page_id for r in some.where("parts IS NOT NULL").collect()} == {0, 1, 2, 3}
    got = signals.with_social_links(some).select("page_id", "page_instagram", "page_facebook").collect()
    assert sorted(got) == sorted(whole.collect()) and sum(r.page_instagram is not None or r.page_facebook is not None for r in got) == 4


def test_few_results_are_held_as_objects():
    class Result(dict):
        live = most = 0

        def __init__(self, text):
            super().__init__(text=text)
            Result.live += 1
            Result.most = max(Result.most, Result.live)

        def __del__(self):
            Result.live -= 1

    values = pa.array([str(i) for i in range(1000)])
    got = arrow.map_values(pa.struct([("text", pa.string())]), Result, values)
    assert [r["text"] for r in got.to_pylist()] == values.to_pylist() and Result.most <= arrow.CHUNK_ROWS + 1
    assert len(arrow.map_values(pa.string(), str, values.slice(0, 0))) == 0
