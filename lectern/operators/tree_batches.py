"""Rules of trees over batches of sentences at a time: what apply_rules does to each sentence, done to the columns of many.

Solutions are found as arrays of places, by the parents of tokens and by ranges of places; actions go over
the columns they write. Rule sets that end early ('once', 'last'), set ids, or mix cuts and joins with other actions
in one rule, and sentences whose ids don't run from 1, are left to apply_rules.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lectern.operators import trees as Y

NONE = -(1 << 40)
#: Rows of the table of partial solutions that are made at once; tokens of sentences that are rewritten together.
ROWS, TOKENS = 1 << 20, 200_000
STORAGE = ("storage", "storage2", "storage3")
TEXT = [f for f in Y.FIELDS if f not in ("id", "head")]
_SEVERAL = ("edep", "ehead", "edom", "deps", "position")


class Unsupported(Exception):
    """What only apply_rules does."""


def _parsed(action: str) -> tuple:
    """(kind, first node or key, second node or field, mode, value)."""
    if m := re.fullmatch(r"#(\d+)(>|~|><)#(\d+)", action):
        return m[2], int(m[1]) - 1, int(m[3]) - 1, "", ""
    if action.startswith("#S:"):
        key, value = action[3:].split("=", 1)
        return "S", key, None, "", value
    m = Y._SET.fullmatch(action)
    if not m:
        raise Unsupported(action)
    if m[2] == "split":
        return "split", int(m[1]) - 1, None, "", m[4]
    field = Y.ALIASES[m[2]]
    if field == "id" or field == "head" and m[3]:
        raise Unsupported(action)
    return "set", int(m[1]) - 1, field, m[3], m[4]


def plan(rules: list[Y.Rule]) -> list[tuple[Y.Rule, list[tuple]]] | None:
    """Rules with their actions, or None if apply_rules has to do them."""
    try:
        out = [(r, [_parsed(a) for a in r.actions]) for r in rules]
    except Unsupported:
        return None
    for _, actions in out:
        kinds = {a[0] for a in actions}
        if kinds & {"split", "><"} and len(kinds) > 1:
            return None
    return out


def _ints(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), NONE).to_numpy(zero_copy_only=False).copy()


class Batch:
    """Columns of the tokens of several sentences, in order."""

    def __init__(self, tokens: pa.Array):
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        flat = tokens.flatten()
        names = [flat.type.field(i).name for i in range(flat.type.num_fields)]
        columns = dict(zip(names, flat.flatten(), strict=True))
        self.n = len(tokens)
        self.sent = np.repeat(np.arange(self.n), lengths)
        self.id, self.head = _ints(columns["id"]), _ints(columns["head"])
        self.upto = _ints(columns["upto"]) if "upto" in columns else np.full(len(self.id), NONE)
        self.text: dict = {f: columns[f] for f in TEXT}
        self.edges: dict[int, dict] = {}
        if "deps" in columns:
            d = columns["deps"]
            for i in np.flatnonzero(pc.fill_null(pc.match_substring(d, ":"), False).to_numpy(zero_copy_only=False)).tolist():
                own = [e.split(":", 1) for e in d[i].as_py().split("|") if ":" in e]
                self.edges[i] = {"edges": [[int(h), r] for h, r in own]}
        self.meta: dict[int, dict] = {}
        if "meta" in columns:
            given = columns["meta"]
            for i in np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(given), 0), False).to_numpy(zero_copy_only=False)).tolist():
                s = int(self.sent[i])
                if s not in self.meta:
                    self.meta[s] = json.loads(given[i].as_py())
        self._place()

    def _place(self) -> None:
        """What follows from sent, id, head and upto: words with their sentences' ranges and parents."""
        self.words = np.flatnonzero(self.upto == NONE)
        s = self.sent[self.words]
        self.count = np.bincount(s, minlength=self.n)
        self.start = np.cumsum(self.count) - self.count
        self.codes_of: dict = {}

    def regular(self) -> np.ndarray:
        """For each sentence, whether the ids of its words run from 1."""
        s = self.sent[self.words]
        wrong = self.id[self.words] != np.arange(len(self.words)) - self.start[s] + 1
        out = np.ones(self.n, bool)
        out[s[wrong]] = False
        return out

    # Values of fields.

    def codes(self, field: str) -> tuple[np.ndarray, list]:
        """Codes of a text field over all tokens, and what they stand for; missing values are '_'."""
        if field not in self.codes_of:
            column = self.text.get(field)
            if column is None:
                self.codes_of[field] = np.zeros(len(self.id), np.int64), ["_"]
            else:
                column = column if isinstance(column, pa.Array) else pa.array(column, pa.string())
                d = pc.fill_null(column, "_").dictionary_encode()
                self.codes_of[field] = d.indices.to_numpy(zero_copy_only=False), d.dictionary.to_pylist()
        return self.codes_of[field]

    def column(self, field: str) -> np.ndarray:
        """A text field to be written."""
        self.codes_of.pop(field, None)
        have = self.text.get(field)
        if have is None:
            have = np.full(len(self.id), "_", object)
        elif isinstance(have, pa.Array):
            have = have.to_numpy(zero_copy_only=False).copy()
        self.text[field] = have
        return have

    def values(self, i: int, field: str, last: int | None = None) -> list[str]:
        """Values of a field of one token, as Sentence.values has them."""
        s = int(self.sent[i])
        if field.startswith("#S:"):
            return [self.meta.get(s, {}).get(field[3:], "_")]
        edges = self.edges.get(i, {"edges": []})["edges"]
        if field in ("edep", "ehead", "edom"):
            return [{"edep": r or "_", "ehead": str(h), "edom": f"{h}||{r or '_'}"}[field] for h, r in edges] or ["_"]
        if field == "deps":
            return [Y.edges_text(edges)]
        if field == "position":
            end = int(self.count[s]) if last is None else last
            return [*(["first"] if self.id[i] == 1 else []), *(["last"] if self.id[i] == end else [])] or ["mid"]
        if field in ("id", "head"):
            v = int(getattr(self, field)[i])
            return [str(v) if v != NONE else "_"]
        codes, names = self.codes(field)
        return [names[codes[i]]]

    def passes(self, tests: tuple[Y.Test, ...]) -> np.ndarray:
        """For each word, whether it passes the tests of a node."""
        w, ok = self.words, np.ones(len(self.words), bool)
        s = self.sent[w]
        if any(t.field.startswith("#S:") for t in tests):
            ok &= np.arange(len(w)) == self.start[s]
        for t in tests:
            if t.field.startswith("#S:"):
                held = np.array([t.holds(self.meta.get(k, {}).get(t.field[3:], "_")) for k in range(self.n)], bool)
                ok &= held[s]
            elif t.field == "position":
                first, last = self.id[w] == 1, self.id[w] == self.count[s]
                one = np.where(first & last, t.holds("first") and t.holds("last") if t.negative else t.holds("first") or t.holds("last"), np.where(first, t.holds("first"), np.where(last, t.holds("last"), t.holds("mid"))))
                ok &= one.astype(bool)
            elif t.field in _SEVERAL:
                own = np.full(len(self.id), t.holds("_"))
                for i in self.edges:
                    own[i] = (all if t.negative else any)(t.holds(v) for v in self.values(i, t.field))
                ok &= own[w]
            elif t.field in ("id", "head"):
                seen, at = np.unique(getattr(self, t.field)[w], return_inverse=True)
                ok &= np.array([t.holds(str(v) if v != NONE else "_") for v in seen.tolist()], bool)[at]
            else:
                codes, names = self.codes(t.field)
                ok &= np.array([t.holds(v) for v in names], bool)[codes[w]]
        return ok

    # Solutions.

    def solutions(self, rule: Y.Rule) -> np.ndarray:
        """Places (of all tokens) of each solution's nodes, in the order in which actions go over them."""
        w, total = self.words, len(self.words)
        s = self.sent[w]
        begin, end = self.start[s], self.start[s] + self.count[s] - 1
        head = self.head[w]
        parent = np.where((head >= 1) & (head <= self.count[s]), begin + head - 1, -1)
        fit = [np.flatnonzero(self.passes(node)) for node in rule.nodes]
        order, done = rule.order(), []
        by_parent: dict = {}

        def children(k: int) -> tuple[np.ndarray, np.ndarray]:
            if k not in by_parent:
                own = fit[k][parent[fit[k]] >= 0]
                own = own[np.argsort(parent[own], kind="stable")]
                by_parent[k] = own, parent[own]
            return by_parent[k]

        def reach(k: int, found: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Candidates of a node, and the range of them for each row."""
            among = lambda lo, hi: (fit[k], np.searchsorted(fit[k], lo), np.searchsorted(fit[k], hi, "right"))
            for a, op, b in rule.relations:
                if b == k and a in found:
                    if op == ">":
                        own, keys = children(k)
                        return own, np.searchsorted(keys, found[a]), np.searchsorted(keys, found[a], "right")
                    if op[0] == ".":
                        lo, hi = Y._reach(op)
                        return among(found[a] + lo, np.minimum(found[a] + hi, end[found[a]]))
                if a == k and b in found:
                    if op == ">":
                        return among(parent[found[b]], parent[found[b]])
                    if op[0] == ".":
                        lo, hi = Y._reach(op)
                        return among(np.maximum(found[b] - hi, begin[found[b]]), found[b] - lo)
            any_ = next(iter(found.values()))
            return among(begin[any_], end[any_])

        def related(a: np.ndarray, op: str, b: np.ndarray) -> np.ndarray:
            if op == ">":
                return parent[b] == a
            if op == "~":
                pairs = zip(w[b].tolist(), self.id[w[a]].tolist(), strict=True)
                return np.array([y in self.edges and any(h == x for h, _ in self.edges[y]["edges"]) for y, x in pairs], bool)
            if op[0] == ".":
                lo, hi = Y._reach(op)
                return (b - a >= lo) & (b - a <= hi)
            field = Y.ALIASES[op[1:-2]]
            if field in ("id", "head"):
                own = getattr(self, field)
                return own[w[a]] == own[w[b]]
            if field in _SEVERAL:
                return np.array([self.values(x, field, 0) == self.values(y, field, 0) for x, y in zip(w[a].tolist(), w[b].tolist(), strict=True)], bool)
            codes = self.codes(field)[0]
            return codes[w[a]] == codes[w[b]]

        def extend(depth: int, found: dict) -> None:
            rows = len(next(iter(found.values()))) if found else 1
            if depth == len(order):
                done.append(np.stack([found[k] for k in range(len(order))], 1))
                return
            if not rows:
                return
            k = order[depth]
            own, lo, hi = reach(k, found) if found else (fit[k], np.zeros(1, np.int64), np.full(1, len(fit[k])))
            n = np.maximum(hi - lo, 0)
            if n.sum() > ROWS and rows > 1:
                half = rows // 2
                for part in (slice(None, half), slice(half, None)):
                    extend(depth, {x: v[part] for x, v in found.items()})
                return
            row = np.repeat(np.arange(rows), n)
            new = own[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            more = {x: v[row] for x, v in found.items()} | {k: new}
            keep = np.ones(len(new), bool)
            for x, v in more.items():
                if x != k:
                    keep &= v != new
            for a, op, b in rule.relations:
                if k in (a, b) and a in more and b in more and keep.any():
                    at = np.flatnonzero(keep)
                    keep[at] = related(more[a][at], op, more[b][at])
            extend(depth + 1, {x: v[keep] for x, v in more.items()})

        if total:
            extend(0, {})
        out = np.concatenate(done) if done else np.zeros((0, len(order)), np.int64)
        return w[out[np.lexsort(out.T[::-1])]]

    def captured(self, rule: Y.Rule, found: np.ndarray) -> list[list[str]]:
        """For each group that the tests capture, its text in each solution."""
        out = []
        for k, node in enumerate(rule.nodes):
            for test in node:
                if test.negative or not test.groups:
                    continue
                at = found[:, k]
                if test.field in self.text or test.field in STORAGE:
                    codes, names = self.codes(test.field)
                    seen, where = np.unique(codes[at], return_inverse=True)
                    own = [test.captured(names[c]) for c in seen.tolist()]
                    got = [own[x] for x in where.tolist()]
                else:
                    got = [next(test.captured(v) for v in self.values(i, test.field) if test.holds(v)) for i in at.tolist()]
                out += [list(g) for g in zip(*got, strict=True)] if got else [[] for _ in range(test.groups)]
        return out

    # Actions.

    def apply(self, rule: Y.Rule, actions: list[tuple]) -> None:
        found = self.solutions(rule)
        if not len(found):
            return
        groups = self.captured(rule, found) if any("$" in a[4] for a in actions) else []

        def filled(value: str) -> list[str]:
            named = sorted({int(x) for x in re.findall(r"\$(\d+)", value)})
            if not named:
                return [value] * len(found)
            known: dict = {}
            out = []
            for own in zip(*[groups[x - 1] for x in named], strict=True):
                if own not in known:
                    at = [""] * named[-1]
                    for x, text in zip(named, own, strict=True):
                        at[x - 1] = text
                    known[own] = Y._filled(value, at)
                out.append(known[own])
            return out

        if actions and actions[0][0] == "split":
            return self._cut([(found[:, a].tolist(), filled(v)) for _, a, _, _, v in actions])
        if actions and actions[0][0] == "><":
            return self._join([(found[:, a].tolist(), found[:, b].tolist()) for _, a, b, _, _ in actions])
        columns: dict[str, list] = {}
        for kind, a, b, mode, value in actions:
            if kind == "S":
                columns.setdefault("#S", []).append((a, filled(value)))
            elif kind in (">", "~"):
                if a != b:
                    columns.setdefault("head" if kind == ">" else "#edges", []).append((kind, found[:, b], self.id[found[:, a]], ""))
            elif b in ("edep", "ehead", "edom"):
                columns.setdefault("#edges", []).append((b, found[:, a], filled(value), mode))
            elif b not in ("deps", "position"):  # what these say is seen nowhere
                columns.setdefault(b, []).append(("set", found[:, a], filled(value), mode))
        for name, own in columns.items():
            if name == "#S":
                for s, *values in zip(self.sent[found[:, 0]].tolist(), *[v for _, v in own], strict=True):
                    self.meta.setdefault(s, {}).update({key: v for (key, _), v in zip(own, values, strict=True)})
            elif name == "#edges":
                self._set_edges(own)
            elif name == "head":
                at = np.stack([x[1] for x in own], 1).ravel()
                self.head[at] = np.stack([x[2] if x[0] == ">" else np.array([int(v) for v in x[2]]) for x in own], 1).ravel()
            else:
                self._write(name, own)

    def _write(self, name: str, own: list[tuple]) -> None:
        column = self.column(name)
        if not any(mode for *_, mode in own):
            values = np.empty((len(own[0][1]), len(own)), object)
            for k, x in enumerate(own):
                values[:, k] = x[2]
            column[np.stack([x[1] for x in own], 1).ravel()] = values.ravel()
            return
        known: dict = {}
        for step in zip(*[[(i, v, mode) for i, v in zip(at.tolist(), values, strict=True)] for _, at, values, mode in own], strict=True):
            for i, value, mode in step:
                if not mode:
                    column[i] = value
                    continue
                key = column[i], value, mode
                if key not in known:
                    t = {name: column[i]}
                    Y._set(t, name, mode, value)
                    known[key] = t[name]
                column[i] = known[key]

    def _set_edges(self, own: list[tuple]) -> None:
        steps = [[(kind, i, v, mode) for i, v in zip(at.tolist(), values if isinstance(values, list) else values.tolist(), strict=True)] for kind, at, values, mode in own]
        for step in zip(*steps, strict=True):
            for kind, i, value, mode in step:
                t = self.edges.get(i)
                if t is None:
                    t = self.edges[i] = {"edges": []}
                if kind == "~":
                    t["edges"].append([value, None])
                else:
                    Y._set(t, kind, mode, value)

    def _cut(self, own: list[tuple[list[int], list[str]]]) -> None:
        """Tokens become their pieces, all of a rule's at once: one pass over what follows them."""
        at = np.array([i for targets, _ in own for i in targets])
        pieces = [v.split("|") for _, values in own for v in values]
        if len(np.unique(at)) < len(at):
            raise Unsupported("a token is cut twice by one rule")
        more = np.zeros(len(self.id), np.int64)
        more[at] = [len(p) - 1 for p in pieces]
        w = self.words
        before = np.cumsum(more[w]) - more[w]
        start = np.append(before, more.sum())[self.start]  # of each sentence; those without words ask for none
        new_id = self.id[w] + before - start[self.sent[w]]
        all_more = np.bincount(self.sent[w], more[w], self.n).astype(np.int64)

        def moved(h: np.ndarray, s: np.ndarray, behind: bool = False) -> np.ndarray:
            """Where ids point after the cut: to a token's first piece, or behind to its last."""
            inside = (h >= 1) & (h <= self.count[s])
            at_ = np.where(inside, self.start[s] + h - 1, 0)
            out = np.where(inside, new_id[at_] + (more[w[at_]] if behind else 0), np.where(h > self.count[s], h + all_more[s], h))
            return np.where(h == NONE, NONE, out)

        new_head, new_upto = moved(self.head, self.sent), moved(self.upto, self.sent, True)
        ids = moved(self.id, self.sent)
        for i, t in self.edges.items():
            s = self.sent[i : i + 1]
            t["edges"] = [[int(moved(np.array([h]), s)[0]), r] for h, r in t["edges"]]
        misc, form = self.column("misc"), self.column("form")
        known: dict = {}
        ends = []
        for i, p in zip(at.tolist(), pieces, strict=True):
            old = misc[i]
            if old not in known:
                known[old] = Y._feature_text(Y._features(old) | {"SpaceAfter": "No"})
            ends.append("SpaceAfter=No" if "SpaceAfter=No" in (old or "") else "_")
            form[i], misc[i] = p[0], known[old]
        times = more + 1
        first = np.cumsum(times) - times
        repeat = lambda x: np.repeat(x, times)
        self.sent, self.id, self.head, self.upto = repeat(self.sent), repeat(ids), repeat(new_head), repeat(new_upto)
        n = more[at]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1  # of the pieces behind the first
        place = np.repeat(first[at], n) + nth
        self.head[place] = self.id[place]
        self.id[place] += nth
        for f in [*TEXT, *STORAGE]:
            if f in self.text:
                self.text[f] = repeat(self.column(f))
        for f in self.text:
            if f not in ("form", "func", "misc"):
                self.text[f][place] = "_"
        self.text["func"][place] = "dep"
        self.text["form"][place] = np.array([x for p in pieces for x in p[1:]], object)
        self.text["misc"][place] = np.array([x for p, e in zip(pieces, ends, strict=True) for x in ["SpaceAfter=No"] * (len(p) - 2) + ([e] if len(p) > 1 else [])], object)
        self.edges = {int(first[i]): t for i, t in self.edges.items()}
        self._place()

    def _join(self, own: list[tuple[list[int], list[int]]]) -> None:
        """Super-tokens over pairs, put in before the first of each."""
        form, misc = self.column("form"), self.column("misc")
        supers = np.flatnonzero(self.upto != NONE)
        have = set(zip(self.sent[supers].tolist(), self.id[supers].tolist(), self.upto[supers].tolist(), strict=True))
        ids, sent = self.id, self.sent
        at, new = [], []
        known: dict = {}

        def bare(value: str | None) -> str:
            if value not in known:
                known[value] = Y._feature_text({k: v for k, v in Y._features(value).items() if k != "SpaceAfter"})
            return known[value]

        for step in zip(*[list(zip(a, b, strict=True)) for a, b in own], strict=True):
            for a, b in step:
                key = int(sent[a]), int(ids[a]), int(ids[b])
                if a == b or key in have:
                    continue
                have.add(key)
                glued = "SpaceAfter=No" if "SpaceAfter=No" in (misc[b] or "") else "_"
                misc[a], misc[b] = bare(misc[a]), bare(misc[b])
                at.append(a)
                new.append((*key, form[a] + form[b], glued))
        if not at:
            return
        places = np.array(at)
        put = lambda x, v: np.insert(x, places, v)
        self.sent, self.id, self.upto = (put(x, [n[k] for n in new]) for k, x in enumerate((self.sent, self.id, self.upto)))
        self.head = put(self.head, NONE)
        for f in list(self.text):
            self.text[f] = put(self.column(f), np.array([n[3] if f == "form" else n[4] if f == "misc" else "_" for n in new], object))
        order = np.sort(places)
        self.edges = {i + int(np.searchsorted(order, i, "right")): t for i, t in self.edges.items()}
        self._place()

    def columns(self) -> tuple[np.ndarray, list[pa.Array]]:
        """The sentence of each token; FIELDS and EXTRA."""
        ints = lambda x: pa.array(x.astype(np.int32), mask=x == NONE)
        known: dict = {}
        facts = [None] * self.n
        for s, m in self.meta.items():
            key = tuple(sorted(m.items())) if all(isinstance(v, str) for v in m.values()) else None
            if key is None or key not in known:
                known[key] = json.dumps(m, sort_keys=True, ensure_ascii=False) if m else None
            facts[s] = known[key]
        edges = np.full(len(self.id), "_", object)
        texts: dict = {}
        for i, t in self.edges.items():
            key = tuple(map(tuple, t["edges"]))
            if key not in texts:
                texts[key] = Y.edges_text(t["edges"])
            edges[i] = texts[key]
        out = []
        for f in Y.FIELDS:
            x = self.text.get(f)
            out.append(ints(getattr(self, f)) if f in ("id", "head") else x if isinstance(x, pa.Array) else pa.array(x, pa.string()))
        deps = pa.array(edges, pa.string()) if self.edges else pa.repeat(pa.scalar("_", pa.string()), len(self.id))
        return self.sent, [*out, deps, ints(self.upto), pa.array(facts, pa.string()).take(pa.array(self.sent))]


def rewritten(tokens: pa.Array, rules: list[Y.Rule]) -> list[tuple[np.ndarray, list[pa.Array]]]:
    """Sentences (lists of tokens) after the rules, in parts: the sentence of each token, FIELDS and EXTRA."""
    planned, out = plan(rules), []
    for at, part in _parts(tokens):
        batch = Batch(part)
        fit = batch.regular() if planned is not None else np.zeros(len(part), bool)
        if fit.any():
            own = np.flatnonzero(fit)
            try:
                batch = batch if len(own) == len(part) else Batch(part.take(pa.array(own)))
                for rule, actions in planned:
                    batch.apply(rule, actions)
                sent, columns = batch.columns()
                out.append((at + own[sent], columns))
            except Unsupported:
                fit[:] = False
        if not fit.all():
            own = np.flatnonzero(~fit)
            done = [Y.rewrite_sentence(t or [], rules) for t in part.take(pa.array(own)).to_pylist()]
            sent = np.array([at + own[k] for k, s in enumerate(done) for _ in s], np.int64)
            out.append((sent, [pa.array([t[f] for s in done for t in s], Y._KINDS.get(f, pa.string())) for f in [*Y.FIELDS, *Y.EXTRA]]))
    return out


def _parts(tokens: pa.Array):
    """Runs of sentences of some TOKENS tokens, with the place of the first."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(tokens):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOKENS, "right")))
        yield at, tokens.slice(at, to - at)
        at = to
