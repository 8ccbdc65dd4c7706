"""Plain block-style YAML to JSON, as one column expression.

A text is cut into lines and folded once from top to bottom. The fold carries the JSON written
so far, the open containers with their indents, and a value that may go on in the next line. What
comes out is typed by ``from_json`` or ``parse_json``.

Read are nested maps and lists, lists of maps, plain values over several lines, single and double
quotes, literal and folded blocks, lists and maps of scalars in brackets, and remarks. Not read,
and reported as the reason, are anchors, tags, complex keys, nested brackets, tabs as indents and
several documents in one text.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number as JSON writes it; ``007`` and ``1_000`` are texts.
NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"
NULLS = ["", "~", "null", "Null", "NULL"]

SINGLE_END = r"^((?:[^']|'')*)'\s*(?:#.*)?$"
DOUBLE_END = r'^((?:[^"\\]|\\.)*)"\s*(?:#.*)?$'
# A key in quotes, or up to the first colon that a blank or the line's end follows.
KEY = r"""^(?:'((?:[^']|'')*)'|"((?:[^"\\]|\\.)*)"|((?:[^\s'"\[\]{}#&*!|>%@`,?-]|[?-](?=\S))(?:[^:]|:(?=\S))*?))\s*:(?:\s+(.*))?$"""
# An item of a list or map in brackets.
ITEM = r"""\s*('(?:[^']|'')*'|"(?:[^"\\]|\\.)*"|[^,'"\[\]{}]+)\s*"""
FLOW_LIST = rf"^\[(?:{ITEM}(?:,{ITEM})*,?)?\s*\]\s*(?:#.*)?$"
FLOW_MAP = rf"^\{{(?:{ITEM}(?:,{ITEM})*,?)?\s*\}}\s*(?:#.*)?$"
# What a value must not begin with: anchors, aliases, tags and reserved signs.
REFUSED = r"^[&*!%@`]|^\? "

STATE = ("struct<out:string,stack:array<struct<ind:int,kind:string>>,mode:string,own:int,buf:string,"
         "gaps:int,block:int,chomp:string,skip:boolean,bad:string>")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Name a value, so that it is computed once however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def _quoted(text: Column) -> Column:
    """A JSON string."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def _double(inner: Column) -> Column:
    """The inside of double quotes is JSON already, but for line breaks and tabs."""
    return F.concat(F.lit('"'), F.replace(F.replace(inner, F.lit("\n"), F.lit(r"\n")), F.lit("\t"), F.lit(r"\t")),
                    F.lit('"'))


def _unquote(inner: Column) -> Column:
    return _quoted(F.replace(inner, F.lit("''"), F.lit("'")))


def _plain(value: Column) -> Column:
    """A value without quotes: null, truth value, number or text."""
    return (F.when(value.isin(*NULLS), "null").when(value.isin("true", "True", "TRUE"), "true")
            .when(value.isin("false", "False", "FALSE"), "false").when(value.rlike(NUMBER), value)
            .otherwise(_quoted(value)))


def _bare(value: Column) -> Column:
    """Without a remark behind it, and blanks around."""
    return F.trim(F.regexp_replace(value, r"(?:^|\s)#.*$", ""))


def _scalar(value: Column) -> Column:
    """A value on one line, quoted or not."""
    return (F.when(value.startswith("'"), _unquote(F.regexp_extract(value, "^'(.*)'$", 1)))
            .when(value.startswith('"'), _double(F.regexp_extract(value, '^"(.*)"$', 1))).otherwise(_plain(value)))


def _flow(value: Column) -> Column:
    """Brackets around scalars; null where they hold anything else."""
    items = F.transform(F.regexp_extract_all(F.regexp_extract(value, r"^[\[{](.*)[\]}]\s*(?:#.*)?$", 1), F.lit(ITEM), F.lit(1)),
                        lambda x: F.trim(x))
    items = F.filter(items, lambda x: x != "")
    pairs = F.transform(items, lambda x: F.concat(
        _quoted(F.regexp_extract(x, r"^([^:]+?)\s*:(?:\s|$)", 1)), F.lit(":"),
        _scalar(F.trim(F.regexp_extract(x, r"^[^:]+?\s*:\s*(.*)$", 1)))))
    # A quoted value of a map entry is an item of its own to the pattern, so entries are plain here.
    fits = F.forall(items, lambda x: x.rlike(r"^[^:'\"]+:(\s|$)"))
    return (F.when(value.rlike(FLOW_LIST), F.concat(F.lit("["), F.array_join(F.transform(items, _scalar), ","), F.lit("]")))
            .when(value.rlike(FLOW_MAP) & fits, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))))


def _lines(text: Column) -> Column:
    """Tokens of all lines: every leading dash is one, the rest of the line another."""
    raw = F.split(F.regexp_replace(text, "^﻿|\r(?=\n)", ""), "\n")

    def tokens(line: Column) -> Column:
        lead = F.regexp_extract(line, r"^ *((?:- +|-$)*)", 0)
        dashes = F.regexp_extract_all(lead, F.lit("(-)"), F.lit(1))
        first = F.length(F.regexp_extract(lead, "^ *", 0))
        rest = F.substring(line, F.length(lead) + 1, F.length(line))
        at = lambda i: F.length(F.regexp_substr(
            lead, F.concat(F.lit("^ *(?:- *){"), i.cast("string"), F.lit("}"))))
        heads = F.transform(dashes, lambda _, i: F.struct(
            line.alias("raw"), F.when(i == 0, first).otherwise(at(i)).alias("ind"), F.lit(True).alias("dash"),
            F.lit("").alias("body"), (i == 0).alias("first")))
        tail = F.struct(line.alias("raw"), F.length(lead).alias("ind"), F.lit(False).alias("dash"),
                        F.rtrim(rest).alias("body"), (F.size(dashes) == 0).alias("first"))
        bare = (F.size(dashes) > 0) & F.trim(rest).rlike("^(#.*)?$")
        return F.when(bare, heads).otherwise(F.array_append(heads, tail))

    return F.flatten(F.transform(raw, tokens))


def _state(s: Column, **change: Column) -> Column:
    names = ["out", "stack", "mode", "own", "buf", "gaps", "block", "chomp", "skip", "bad"]
    return F.struct(*[change.get(n, s[n]).alias(n) for n in names]).cast(STATE)


def _flushed(s: Column) -> Column:
    """The JSON of the value that is still open."""
    end = (F.when(s["chomp"] == "-", "").when(s["chomp"] == "+", F.repeat(F.lit("\n"), s["gaps"] + 1))
           .otherwise("\n"))
    return (F.when(s["mode"] == "key", "null").when(s["mode"] == "plain", _plain(s["buf"]))
            .when(s["mode"].isin("literal", "folded"), _quoted(
                F.when(s["block"] < 0, "").otherwise(F.concat(s["buf"], end))))
            .otherwise(""))


def _closed(popped: Column) -> Column:
    return F.array_join(F.transform(F.reverse(popped), lambda c: F.when(c["kind"] == "m", "}").otherwise("]")), "")


def _valued(s: Column, out: Column, value: Column, stack: Column, own: Column) -> Column:
    """The state after ``value`` began, behind what was written to ``out``."""
    line = lambda **c: _state(s, **{"stack": stack, "own": own, "gaps": F.lit(0), "out": out, "bad": F.lit(None), **c})
    done = lambda json: line(out=F.concat(out, json), mode=F.lit("done"))
    single, double = F.substring(value, 2, 1 << 30), F.substring(value, 2, 1 << 30)
    block = F.regexp_extract(value, r"^[|>]([-+]?)\s*(?:#.*)?$", 1)
    flow = _flow(value)
    return (F.when(_bare(value) == "", line(mode=F.lit("key")))
            .when(value.startswith("'"), F.when(
                single.rlike(SINGLE_END), done(_unquote(F.regexp_extract(single, SINGLE_END, 1))))
                .otherwise(line(mode=F.lit("single"), buf=F.rtrim(single))))
            .when(value.startswith('"'), F.when(
                double.rlike(DOUBLE_END), done(_double(F.regexp_extract(double, DOUBLE_END, 1))))
                .otherwise(line(mode=F.lit("double"), buf=F.rtrim(double))))
            .when(value.rlike(r"^[|>][-+]?\s*(?:#.*)?$"), line(
                mode=F.when(value.startswith("|"), "literal").otherwise("folded"), block=F.lit(-1),
                chomp=block, buf=F.lit("")))
            .when(value.rlike(r"^[\[{]"), F.when(flow.isNotNull(), done(flow)).otherwise(
                line(bad=F.concat(F.lit("brackets not understood: "), value))))
            .when(value.rlike(REFUSED), line(bad=F.concat(F.lit("not plain: "), value)))
            .otherwise(line(mode=F.lit("plain"), buf=_bare(value))))


def _continued(s: Column, t: Column) -> Column:
    """The state if the line goes on with an open value, else null."""
    trimmed = F.trim(t["raw"])
    blank = trimmed == ""
    more = lambda **c: _state(s, **{"skip": F.lit(True), **c})
    breaks = lambda n: F.repeat(F.lit("\n"), n)
    fold = F.when(s["gaps"] > 0, breaks(s["gaps"])).otherwise(" ")

    def closing(end: str, json: Callable[[Column], Column]) -> Column:
        joined = F.concat(s["buf"], fold)
        return (F.when(blank, more(gaps=s["gaps"] + 1))
                .when(trimmed.rlike(end), more(
                    out=F.concat(s["out"], json(F.concat(joined, F.regexp_extract(trimmed, end, 1)))),
                    mode=F.lit("done"), gaps=F.lit(0)))
                .otherwise(more(buf=F.concat(joined, trimmed), gaps=F.lit(0))))

    ind = F.length(F.regexp_extract(t["raw"], "^ *", 0))
    margin = F.when(s["block"] < 0, ind).otherwise(s["block"])
    content = F.substring(t["raw"], margin + 1, F.length(t["raw"]))
    between = F.when(s["block"] < 0, breaks(s["gaps"])).when(
        s["mode"] == "literal", breaks(s["gaps"] + 1)).otherwise(fold)
    block = F.when(blank, more(gaps=s["gaps"] + 1)).when(ind > s["own"], more(
        buf=F.concat(s["buf"], between, content), gaps=F.lit(0), block=margin))
    plain = F.when(blank, more(gaps=s["gaps"] + 1)).when((ind > s["own"]) & ~trimmed.startswith("#"), F.when(
        trimmed.rlike(r":(\s|$)"), more(bad=F.concat(F.lit("a key within a value: "), trimmed))).otherwise(
            more(buf=F.concat(s["buf"], fold, _bare(trimmed)), gaps=F.lit(0))))
    return (F.when(s["mode"] == "single", closing(SINGLE_END, _unquote))
            .when(s["mode"] == "double", closing(DOUBLE_END, _double))
            .when(s["mode"].isin("literal", "folded"), block).when(s["mode"] == "plain", plain))


def _began(s: Column, t: Column) -> Column:
    """The state after a dash, a key or a value at the beginning of its line."""
    ind, top = t["ind"], F.try_element_at(s["stack"], F.lit(-1))["kind"]
    body = t["body"]
    is_key = ~t["dash"] & body.rlike(KEY)
    waits = s["mode"] == "key"
    kind = F.when(t["dash"], "s").otherwise("m")
    inside = waits & F.when(t["dash"], (ind > s["own"]) | ((ind == s["own"]) & (F.coalesce(top, F.lit("")) == "m"))).otherwise(
        ind > s["own"])
    held = F.filter(s["stack"], lambda c: (c["ind"] < ind) | ((c["ind"] == ind) & (t["dash"] | (c["kind"] == "m"))))
    popped = F.slice(s["stack"], F.size(held) + 1, F.greatest(F.size(s["stack"]) - F.size(held), F.lit(0)))
    last = F.try_element_at(held, F.lit(-1))
    fits = F.coalesce((last["ind"] == ind) & (last["kind"] == kind), F.lit(False))
    opened = F.concat(s["out"], F.when(t["dash"], "[").otherwise("{"))
    followed = F.concat(s["out"], _flushed(s), _closed(popped), F.lit(","))
    pushed = F.array_append(s["stack"], F.struct(ind.alias("ind"), kind.alias("kind")))
    wrong = lambda why: _state(s, bad=F.concat(F.lit(why), t["raw"]))
    name = F.coalesce(
        F.when(body.startswith("'"), _unquote(F.regexp_extract(body, KEY, 1))),
        F.when(body.startswith('"'), _double(F.regexp_extract(body, KEY, 2))), _quoted(F.regexp_extract(body, KEY, 3)))
    value = F.coalesce(F.regexp_extract(body, KEY, 4), F.lit(""))

    def entered(out: Column, stack: Column) -> Column:
        item = _state(s, out=out, stack=stack, mode=F.lit("key"), own=ind, gaps=F.lit(0))
        return F.when(t["dash"], item).otherwise(
            _valued(s, F.concat(out, name, F.lit(":")), value, stack, ind))

    return (F.when(t["raw"].rlike(r"^ *\t"), wrong("a tab before: "))
            .when(~t["dash"] & ~is_key, F.when(waits & (ind > s["own"]), _valued(
                s, s["out"], body, s["stack"], s["own"])).otherwise(wrong("neither key nor item: ")))
            .when(inside, entered(opened, pushed))
            .when(fits, entered(followed, held))
            .otherwise(wrong("indent does not fit: ")))


def _next(s: Column, t: Column) -> Column:
    """The state after a token that no open value has taken."""
    idle = ~t["dash"] & F.trim(t["body"]).rlike("^(#.*)?$")
    fence = t["raw"].rlike(r"^(---|\.\.\.)\s*$")
    first = (s["out"] == "") & (s["mode"] == "key")
    return (F.when(fence & first | idle, s).when(fence, _state(s, bad=F.lit("several documents")))
            .otherwise(_began(s, t)))


def to_json(text: Column) -> Column:
    """A struct of ``json`` and ``reason``; one of them is null.

    An empty text, or one of remarks only, is the JSON null. The fold copies what is written with
    every line, so it is meant for records and registries, not for texts of many megabytes.
    """

    def step(s: Column, t: Column) -> Column:
        fresh = F.when(t["first"], F.coalesce(_continued(s, t), _state(s, skip=F.lit(False)))).otherwise(s)
        return F.when(s["bad"].isNotNull(), s).otherwise(
            _let(fresh, lambda x: F.when(x["skip"], x).otherwise(_next(x, t))))

    none = F.lit(None)
    start = F.struct(
        F.lit("").alias("out"), F.array().cast("array<struct<ind:int,kind:string>>").alias("stack"),
        F.lit("key").alias("mode"), F.lit(-1).alias("own"), F.lit("").alias("buf"), F.lit(0).alias("gaps"),
        F.lit(-1).alias("block"), F.lit("").alias("chomp"), F.lit(False).alias("skip"), none.cast("string").alias("bad"))

    def finish(s: Column) -> Column:
        bad = F.coalesce(s["bad"], F.when(s["mode"].isin("single", "double"), "a quote is not closed"))
        json = F.concat(s["out"], _flushed(s), _closed(s["stack"]))
        return F.struct(F.when(bad.isNull(), json).alias("json"), bad.alias("reason"))

    return F.aggregate(_lines(text), start.cast(STATE), step, finish)
