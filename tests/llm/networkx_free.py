"""Components by plain search."""


def components(edges):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [start] if start not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out
