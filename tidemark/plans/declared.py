"""What a view's declaration says about its stored data, in a form that can be compared.

Stored rows and tiles answer for a view only if they were computed by the same code from the same
sources. Names do not tell: a body may be edited while its view keeps its name. So every job
notes a digest of what the body does, and a reader takes only what has the digest of its own view.
"""

from __future__ import annotations

import hashlib
import json
import re
from types import CodeType, FunctionType

from tidemark.functions.time import instant_micros, micros
from tidemark.plans.views import View

_PLACE = re.compile(r" at 0x[0-9a-f]+")


def _constant(value, seen: set) -> object:
    if isinstance(value, CodeType):
        return _code(value, seen)
    if isinstance(value, FunctionType):
        return _function(value, seen)
    if isinstance(value, (tuple, list)):
        return [_constant(v, seen) for v in value]
    if isinstance(value, (set, frozenset)):
        return sorted(repr(_constant(v, seen)) for v in value)
    if isinstance(value, dict):
        return sorted((repr(k), repr(_constant(v, seen))) for k, v in value.items())
    return _PLACE.sub("", repr(value))


def _code(code: CodeType, seen: set) -> list:
    # without what only says where the code stands
    return [code.co_code.hex(), _constant(code.co_consts, seen), list(code.co_names), list(code.co_varnames), list(code.co_freevars)]


def _function(body: FunctionType, seen: set) -> object:
    """The code of a function, what it encloses, its defaults, and the functions and values of its
    own module that it names."""
    if body in seen:
        return body.__name__
    seen.add(body)
    named = [(n, body.__globals__[n]) for n in sorted(set(body.__code__.co_names)) if n in body.__globals__]
    own = [
        (n, _constant(v, seen))
        for n, v in named
        if (isinstance(v, FunctionType) and v.__module__ == body.__module__) or isinstance(v, (str, int, float, tuple))
    ]
    cells = [c.cell_contents for c in body.__closure__ or ()]
    return [_code(body.__code__, seen), _constant(cells, seen), _constant(body.__defaults__, seen), _constant(body.__kwdefaults__ or {}, seen), own]


def body_digest(view: View) -> str:
    """A digest of what computes the rows of a view.

    Of a SQL view the text counts, of any other the code, with the helpers of its own module;
    what helpers of other modules do is not looked into. Code compiled by another version of
    Python counts as changed, which costs a computation and never gives a wrong answer.
    """
    if view.mode == "sql":
        does: object = view.body(**{s.name: f"{{{s.name}}}" for s in view.sources})
    elif isinstance(view.body, FunctionType):
        does = _function(view.body, set())
    else:
        does = _constant(view.body, set())
    facts = [view.mode, [[s.name, s.ts, s.filtered] for s in view.sources], does]
    return hashlib.sha256(json.dumps(facts).encode()).hexdigest()


def shape(view: View) -> str:
    """How stored data is laid out: one with other keys, time or interval cannot be read at all."""
    facts = {"keys": list(view.keys), "ts": view.ts}
    if view.aggregations:
        facts["interval"] = micros(view.interval)
    return json.dumps(facts)


def start_of(view: View) -> int | None:
    return None if view.start is None else instant_micros(view.start)


def finished_digest(view: View) -> str:
    """A digest of all that finished values depend on, as a folder name."""
    does = [shape(view), body_digest(view), start_of(view), view.features]
    does += [str(view.schedule), str(view.ttl)]
    return hashlib.sha256(json.dumps(does).encode()).hexdigest()[:16]
