r"""Chat formatting through a compiled template.

The template language has text, `{{ expression }}`, `{% for x in y %}`, `{% if %}`/`{% elif %}`/`{% else %}`, and
`{% generation %}`, which marks what a model learns to write. Expressions have literals, names, `.key` and
`["key"]` lookups, `~` (join as text), `+`, `==`, `!=`, `<`, `>`, `in`, `not`, `and`, `or` and filters after
`|`. It is a sandbox: names come from the context alone, lookups only see keys of mappings and items of lists,
nothing can be called but the filters handed in, and no loop runs over anything but given values.

Source is parsed into a tree, constant parts are folded, and each node becomes a Python closure that
yields (text, marked) pieces. A template renders a whole conversation: what stands before and after its loop comes once,
and `loop.index`, `.index0`, `.first` and `.last` count through all turns. Where `messages` is only the source of one
outermost loop, as in most templates, turns stream through it, however many there are; a template that looks at
`messages` in any other way gets the conversation's turns as a list.

Texts keep their control strings apart by a backslash: a backslash becomes two, and one is put before each control
string. In a formatted conversation the first `</turn>` that no backslash escapes is therefore the
end of the turn, and dropping one backslash per escape gives back the text.

Defined results: a null text or role is empty; turns are taken by turn number (null first), then role and text;
a null conversation id is a conversation of its own. Equal rows are turns of their own. An empty table still
gives the probe conversation where it is asked for.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import functions as F

TEMPLATE = (
    '{% for message in messages %}### {{ message.role | escape_role }}: '
    '{% if message.role == "assistant" %}{% generation %}{{ message.text | escape }}{% endgeneration %}'
    '{% else %}{{ message.text | escape }}{% endif %}</turn>\n{% endfor %}')
END = "</turn>"
START, AFTER_ROLE = "### ", ": "
CHUNK = 1 << 20  # characters of formatted text in a row; a chunk ends with a turn
PROBE = r"\### Assistant: </turn> ok"


def escape(text):
    return text.replace("\\", "\\\\").replace("###", "\\###").replace(END, "\\" + END)


def escape_role(text):
    return escape(text).replace(AFTER_ROLE, "\\" + AFTER_ROLE)


def unescape(text):
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


FILTERS = {"escape": escape, "escape_role": escape_role, "upper": str.upper, "lower": str.lower, "trim": str.strip, "length": len}


class TemplateError(ValueError):
    """The template is not in the language."""


TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?\s*(.*?)\s*-?%\}", re.S)
SYMBOL = re.compile(r"""\s*(?:(?P<text>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[~+|.()\[\]<>]))""", re.S)
WORDS = {"true": True, "false": False, "none": None}


def _symbols(source):
    found, at, source = [], 0, source.rstrip()
    while at < len(source):
        m = SYMBOL.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:at + 20]!r}")
        found.append((m.lastgroup, m.group(m.lastgroup)))
        at = m.end()
    return found + [("end", "")]


class _Expression:
    """Parser of one expression into nested tuples: (kind, parts...)."""

    LEVELS = [("or",), ("and",), ("not",), ("==", "!=", "<", ">", "in"), ("~", "+"), ("|",)]

    def __init__(self, source):
        self._symbols, self._at = _symbols(source), 0
        self.tree = self._level(0)
        if self._now()[0] != "end":
            raise TemplateError(f"unexpected {self._now()[1]!r} in {source!r}")

    def _now(self):
        return self._symbols[self._at]

    def _take(self, value=None):
        kind, text = self._now()
        if value is not None and text != value or kind == "end":
            raise TemplateError(f"expected {value or 'more'}, found {text!r}")
        self._at += 1
        return kind, text

    def _level(self, n):
        if n == len(self.LEVELS):
            return self._value()
        if self.LEVELS[n] == ("not",):
            if self._now() == ("name", "not"):
                self._take()
                return ("not", self._level(n))
            return self._level(n + 1)
        left = self._level(n + 1)
        while self._now()[1] in self.LEVELS[n] and self._now()[0] in ("mark", "name"):
            mark = self._take()[1]
            if mark == "|":
                left = ("filter", self._take()[1], left)
            else:
                left = ("pair", mark, left, self._level(n + 1))
        return left

    def _value(self):
        kind, text = self._take()
        if kind == "text":
            tree = ("constant", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1], flags=re.S))
        elif kind == "number":
            tree = ("constant", int(text))
        elif kind == "name":
            tree = ("constant", WORDS[text]) if text in WORDS else ("name", text)
        elif text == "(":
            tree = self._level(0)
            self._take(")")
        else:
            raise TemplateError(f"unexpected {text!r}")
        while self._now()[1] in (".", "[") and self._now()[0] == "mark":
            if self._take()[1] == ".":
                tree = ("lookup", tree, ("constant", self._take()[1]))
            else:
                tree = ("lookup", tree, self._level(0))
                self._take("]")
        return tree


def parse(source):
    """The template as a list of nodes: ("text", s), ("value", e), ("for", name, e, body), ("if", [(e, body)...]),
    ("generation", body)."""
    root, open_, at = [], [], 0
    body = root
    for m in TAG.finditer(source):
        if m.start() > at:
            body.append(("text", source[at:m.start()]))
        at = m.end()
        if m[1] is not None:
            body.append(("value", _Expression(m[1]).tree))
            continue
        word, _, rest = m[2].partition(" ")
        if word == "for":
            name, _, values = rest.strip().partition(" in ")
            if not name.isidentifier() or not values:
                raise TemplateError(f"bad loop {m[2]!r}")
            open_.append(("for", body))
            body.append(("for", name, _Expression(values).tree, []))
            body = body[-1][3]
        elif word == "if":
            open_.append(("if", body))
            body.append(("if", [(_Expression(rest).tree, [])]))
            body = body[-1][1][-1][1]
        elif word in ("elif", "else") and open_ and open_[-1][0] == "if":
            branches = open_[-1][1][-1][1]
            branches.append((_Expression(rest).tree if word == "elif" else ("constant", True), []))
            body = branches[-1][1]
        elif word == "generation":
            open_.append(("generation", body))
            body.append(("generation", []))
            body = body[-1][1]
        elif word.startswith("end") and open_ and open_[-1][0] == word[3:]:
            body = open_.pop()[1]
        else:
            raise TemplateError(f"unexpected tag {m[2]!r}")
    if open_:
        raise TemplateError(f"{open_[-1][0]} is not closed")
    if at < len(source):
        body.append(("text", source[at:]))
    return root


def _as_text(value):
    return "" if value is None else str(value)


PAIRS = {
    "~": lambda a, b: _as_text(a) + _as_text(b), "+": lambda a, b: a + b, "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "in": lambda a, b: a in b}


def _look_up(holder, key):
    if isinstance(holder, dict):
        return holder.get(key)
    if isinstance(holder, (list, tuple)) and isinstance(key, int):
        return holder[key] if -len(holder) <= key < len(holder) else None
    return None


def fold(tree, filters):
    """The expression with its constant parts worked out."""
    kind = tree[0]
    if kind == "filter":
        if tree[1] not in filters:
            raise TemplateError(f"unknown filter {tree[1]!r}")
        inner = fold(tree[2], filters)
        return ("constant", filters[tree[1]](inner[1])) if inner[0] == "constant" else ("filter", tree[1], inner)
    if kind == "not":
        inner = fold(tree[1], filters)
        return ("constant", not inner[1]) if inner[0] == "constant" else ("not", inner)
    if kind == "lookup":
        holder, key = fold(tree[1], filters), fold(tree[2], filters)
        return ("constant", _look_up(holder[1], key[1])) if holder[0] == key[0] == "constant" else ("lookup", holder, key)
    if kind == "pair":
        left, right = fold(tree[2], filters), fold(tree[3], filters)
        if left[0] == "constant" and tree[1] in ("and", "or"):
            return right if bool(left[1]) == (tree[1] == "and") else left
        if left[0] == right[0] == "constant" and tree[1] in PAIRS:
            return ("constant", PAIRS[tree[1]](left[1], right[1]))
        return ("pair", tree[1], left, right)
    return tree


def fold_body(body, filters):
    """Nodes with constants folded, dead branches dropped and neighbouring texts joined."""
    result = []
    for node in body:
        if node[0] == "value":
            tree = fold(node[1], filters)
            new = [("text", _as_text(tree[1]))] if tree[0] == "constant" else [("value", tree)]
        elif node[0] == "for":
            new = [("for", node[1], fold(node[2], filters), fold_body(node[3], filters))]
        elif node[0] == "generation":
            new = [("generation", fold_body(node[1], filters))]
        elif node[0] == "if":
            branches = []
            for test, inner in node[1]:
                test = fold(test, filters)
                if test[0] == "constant" and not test[1]:
                    continue
                branches.append((test, fold_body(inner, filters)))
                if test[0] == "constant":
                    break
            new = branches[0][1] if branches and branches[0][0][0] == "constant" else [("if", branches)] if branches else []
        else:
            new = [node]
        for part in new:
            if part[0] == "text" and result and result[-1][0] == "text":
                result[-1] = ("text", result[-1][1] + part[1])
            else:
                result.append(part)
    return result


def _closure(tree, filters):
    kind = tree[0]
    if kind == "constant":
        return lambda scope, value=tree[1]: value
    if kind == "name":
        return lambda scope, name=tree[1]: scope.get(name)
    if kind == "filter":
        inner, apply = _closure(tree[2], filters), filters[tree[1]]
        return lambda scope: apply(inner(scope))
    if kind == "not":
        inner = _closure(tree[1], filters)
        return lambda scope: not inner(scope)
    left, right = _closure(tree[-2], filters), _closure(tree[-1], filters)
    if kind == "lookup":
        return lambda scope: _look_up(left(scope), right(scope))
    if tree[1] == "and":
        return lambda scope: left(scope) and right(scope)
    if tree[1] == "or":
        return lambda scope: left(scope) or right(scope)
    apply_pair = PAIRS[tree[1]]
    return lambda scope: apply_pair(left(scope), right(scope))


def _renderer(body, filters, marked=False):
    steps = []
    for node in body:
        if node[0] == "text":
            steps.append(lambda scope, piece=(node[1], marked): (piece,))
        elif node[0] == "value":
            steps.append(lambda scope, value=_closure(node[1], filters): ((_as_text(value(scope)), marked),))
        elif node[0] == "generation":
            steps.append(_renderer(node[1], filters, True))
        elif node[0] == "if":
            steps.append(_branches([(_closure(t, filters), _renderer(b, filters, marked)) for t, b in node[1]]))
        else:
            steps.append(_loop(node[1], _closure(node[2], filters), _renderer(node[3], filters, marked), node[2] == MESSAGES))

    def render(scope):
        for step in steps:
            yield from step(scope)
    return render


def _branches(branches):
    def render(scope):
        for test, body in branches:
            if test(scope):
                yield from body(scope)
                return
    return render


MESSAGES = ("name", "messages")
TURN_END = ("", None)  # the piece after each turn of a loop over the messages


def _loop(name, values, body, over_messages):
    def render(scope):
        given = iter(values(scope) or ())
        ahead = next(given, STOP)
        i = 0
        while ahead is not STOP:
            value, ahead = ahead, next(given, STOP)
            yield from body({**scope, name: value, "loop": {"index": i + 1, "index0": i, "first": i == 0, "last": ahead is STOP}})
            if over_messages:
                yield TURN_END
            i += 1
    return render


STOP = object()


def _places(body, inside=False):
    """For each mention of the messages in a tree: whether it is the source of an outermost loop."""
    if body == MESSAGES:
        yield False
    elif isinstance(body, tuple) and body[:1] == ("for",):
        if body[2] == MESSAGES:
            yield not inside
        else:
            yield from _places(body[2], inside)
        yield from _places(body[3], True)
    elif isinstance(body, (tuple, list)):
        for part in body:
            yield from _places(part, inside)


def takes_a_stream(source, filters=FILTERS):
    """Whether a template goes through the messages once, so that an iterator will do."""
    return list(_places(fold_body(parse(source), filters))) in ([True], [])


def compile_template(source, filters=FILTERS):
    """A function of the context that yields (text, marked) pieces in order, and TURN_END after each turn."""
    return _renderer(fold_body(parse(source), filters), filters)


def _messages(batches):
    """(conversation, turns) of rows sorted by conversation; turns is an iterator over one conversation."""
    def rows():
        for batch in batches:
            yield from zip(*[batch.column(i).to_pylist() for i in range(3)])

    rows = rows()
    ahead = next(rows, None)
    while ahead is not None:
        current = ahead[0]

        def turns():
            nonlocal ahead
            while ahead is not None and ahead[0] == current:
                row, ahead = ahead, None
                yield {"role": row[1] or "", "text": row[2] or ""}
                ahead = next(rows, None)
        mine = turns()
        yield current, mine
        for _ in mine:
            pass


CHUNKS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("text", pa.string()), ("loss", pa.list_(pa.list_(pa.int64())))])


def formatted(conversations, template=TEMPLATE, id_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """Formatted conversations in chunks of whole turns: conv_id, chunk, text, loss (spans in code points). What a
    template has before its turns is in the first chunk, what it has after them in the last.

    Rows stay ordered by conversation and chunk, and a conversation stays in one partition; a conversation streams
    through its task turn by turn.
    """
    rows = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), F.col(turn_col).alias("turn"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def render(batches):
        run, streams, out, size = compile_template(template), takes_a_stream(template), [], 0
        for conv_id, turns in _messages(batches):
            chunk, parts, loss, at = 0, [], [], 0
            for text, marked in run({"messages": turns if streams else list(turns)}):
                if marked is not None:
                    if marked and text:
                        loss.append([at, at + len(text)])
                    parts.append(text)
                    at += len(text)
                elif at >= CHUNK:
                    out.append({"conv_id": conv_id, "chunk": chunk, "text": "".join(parts), "loss": loss})
                    size += at
                    chunk, parts, loss, at = chunk + 1, [], [], 0
                    if size >= CHUNK:
                        yield pa.RecordBatch.from_pylist(out, CHUNKS)
                        out, size = [], 0
            if at or not chunk:
                out.append({"conv_id": conv_id, "chunk": chunk, "text": "".join(parts), "loss": loss})
                size += at
            if size >= CHUNK or len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, CHUNKS)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, CHUNKS)

    return ordered.mapInArrow(render, "conv_id long, chunk long, text string, loss array<array<long>>")


MARK = re.compile(r"\\.|</turn>|: ", re.S)


def turns_of(text):
    """(role, text) of each turn of a text formatted by TEMPLATE; other templates mark their turns in other ways."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn at {at}")
        role_end = text_end = None
        for m in MARK.finditer(text, at + len(START)):
            if m[0] == AFTER_ROLE and role_end is None:
                role_end = m.start()
            elif m[0] == END and role_end is not None:
                text_end = m.start()
                break
        if text_end is None:
            raise ValueError(f"turn at {at} has no end")
        yield unescape(text[at + len(START):role_end]), unescape(text[role_end + len(AFTER_ROLE):text_end])
        at = text_end + len(END) + 1


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
DIGEST_SCHEMA = pa.schema([(c, pa.string() if "sha256" in c else pa.int64()) for c in (x.split()[0] for x in DIGESTS.split(", "))])


def digests(chunks):
    """What the formatted conversations say, read back from their texts and spans: one row per conversation."""
    def read(batches):
        current, out = None, []

        def close():
            conv_id, turns, turn_hash, loss_chars, loss_hash, size = current
            out.append(dict(zip(DIGEST_SCHEMA.names, (conv_id, turns, turn_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), size))))

        for batch in batches:
            for conv_id, chunk, text, loss in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if chunk == 0:
                    if current:
                        close()
                    current = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in turns_of(text):
                    current[1] += 1
                    current[2].update(f"{role}\n{said}\n".encode())
                for a, b in loss:
                    said = unescape(text[a:b])
                    current[3] += len(said)
                    current[4].update(said.encode())
                current[5] += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, DIGEST_SCHEMA)
                out = []
        if current:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, DIGEST_SCHEMA)

    return chunks.mapInArrow(read, DIGESTS)


def with_probe(conversations, conv_id=-7, text=PROBE):
    """The conversations and one more whose texts consist of control strings."""
    rows = [(conv_id, 0, "user", text), (conv_id, 1, "assistant", text)]
    probe = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
