"""Stored times don't depend on the zone of the driver process."""

import os
import subprocess
import sys

SCRIPT = """
import datetime as dt, sys, tempfile
from newsloom.session import build_session
from newsloom.operators import paging, rules, writes
from newsloom.functions.times import ntz
spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="newsloom-test-")})
rows = [(f"id{i:02d}", f"2024-01-{i % 5 + 1:02d} 00:00:00", f"2024-05-01 0{i % 7}:00:00") for i in range(20)]
df = spark.createDataFrame(rows, "id string, p string, c string").selectExpr(
    "id", "cast(p as timestamp_ntz) published_date", "cast(c as timestamp_ntz) created_at")
keys = paging.listing_keys()
full = [r.id for r in paging.order(df, keys).collect()]
seen, cursor = [], None
while True:
    page = paging.keyset_page(df, cursor, 6, keys)
    got = [r.id for r in page.collect()]
    if not got:
        break
    seen += got
    cursor = paging.cursor_of(page, keys)
assert seen == full, (seen, full)
now = dt.datetime(2026, 12, 1, 5)
ok, _ = writes.apply_contract(df.selectExpr("id title", "id url", "id source"), now)
assert {str(x) for (x,) in ok.selectExpr("cast(created_at as string)").collect()} == {"2026-12-01 05:00:00"}
up = writes.update_by_key(df.selectExpr("id", "created_at updated_at"), df.filter("id = 'id03'").select("id"), "id", now)
assert up.filter("id = 'id03'").selectExpr("cast(updated_at as string) t").first().t == "2026-12-01 05:00:00"
aware = dt.datetime(2026, 12, 1, 14, tzinfo=dt.timezone(dt.timedelta(hours=9)))
assert df.limit(1).select(ntz(aware).cast("string").alias("t")).first().t == "2026-12-01 05:00:00"
print("zone ok")
"""


def test_times_in_a_second_zone():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"TZ": "Asia/Tokyo", "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert "zone ok" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
