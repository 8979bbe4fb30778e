import math


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def rows_of(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def duck_rows(con, sql, cols):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    idx = {c: i for i, c in enumerate(names)}
    return sorted((tuple(norm(r[idx[c]]) for c in cols) for r in cur.fetchall()), key=_key)


def sort_rows(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=_key)
