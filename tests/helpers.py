import hashlib
import json

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if isinstance(v, dict):
        return {str(k): _norm(x) for k, x in sorted(v.items())}
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def rows_of(df):
    return [tuple(r) for r in df.collect()]
