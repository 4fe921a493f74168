"""Run every registered query on one scale factor and print row counts."""
import sys, time
sys.path.insert(0, "/root/repo")
from martkit.session import build_session
from martkit.plans.queries import REGISTRY

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
names = sys.argv[2:] or sorted(REGISTRY)
spark = build_session("local[8]", 8)
for n in names:
    t0 = time.time()
    try:
        df = REGISTRY[n](spark, sf)
        cnt = df.count()
        print(f"{n:28s} rows={cnt:8d} cols={len(df.columns):3d} {time.time()-t0:6.2f}s", flush=True)
    except Exception as e:
        print(f"{n:28s} FAILED {type(e).__name__}: {str(e)[:300]}", flush=True)
