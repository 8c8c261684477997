"""Summarise a Spark event log (zstd or plain): slowest stages and shuffle rows."""
import glob
import io
import json
import os
import sys

import zstandard


def lines(path):
    files = sorted(glob.glob(os.path.join(path, "*"))) if os.path.isdir(path) else [path]
    for fn in files:
        raw = open(fn, "rb").read()
        if fn.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode().splitlines()


st = {}
for line in lines(sys.argv[1]):
    e = json.loads(line)
    if e.get("Event") == "SparkListenerStageCompleted":
        i = e["Stage Info"]
        d = (i.get("Completion Time", 0) - i.get("Submission Time", 0)) / 1000
        sh = next((a.get("Value") for a in i.get("Accumulables", [])
                   if a.get("Name") == "internal.metrics.shuffle.write.recordsWritten"), 0)
        st[i["Stage ID"]] = (round(d, 2), i["Number of Tasks"], sh, i["Stage Name"][:50])
for k, v in sorted(st.items(), key=lambda x: -x[1][0])[:int(sys.argv[2]) if len(sys.argv) > 2 else 15]:
    print(k, v)
print("total stage sec", round(sum(v[0] for v in st.values()), 1), "stages", len(st))
