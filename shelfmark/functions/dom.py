"""Elements of HTML by matching tags, however deep they are nested.

The HTML is cut into tokens: tags, texts, and comments, scripts and styles whole. One pass over the tags
keeps the elements that are open, as a parser does: a closing tag ends the innermost open element of its
name and all that are open within it, and does nothing if there is none; at the end of the HTML all
are closed. Elements are given by their first and last token, so that an element is a slice.

The pass is an aggregate over an array, written as SQL text, which is one call where columns would be a
thousand.
"""

from pyspark.sql import functions as F

from .columns import sql_text
from .html import CODE, COMMENT, NAME_END, REST_OF_TAG, opening_pattern

_TOKEN = rf"<(?:{COMMENT}|{CODE}|/?[a-zA-Z]{REST_OF_TAG}|[!?][^>]*+>)|[^<]++|<"
_NAME = r"^</?([a-zA-Z][^\s/>]*)"
_MARKUP = r"^<[a-zA-Z/!?]"

# Elements that have no content and no closing tag.
_EMPTY = (
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr"
).split()
_ALONE = rf"^<(?i:{'|'.join(_EMPTY)}){NAME_END}|/>$"

_ONE_TAG = rf"^</?[a-zA-Z]{REST_OF_TAG}\z"
_INERT_DEPTH = 3  # elements in elements that a coarse piece may hold; deeper ones are cut as ever


def _coarse_token(tag):
    """As _TOKEN, but texts, comments and whole elements in each other, none of them `tag`, are one piece.

    An element that is closed by its own tag, with only such elements within, leaves open what was open
    before it.
    """
    other = rf"(?!(?i:{tag}|script|style){NAME_END})"
    # Those without content are whole by themselves, and a closing tag of theirs ends nothing.
    alone = rf"{other}(?:(?i:{'|'.join(_EMPTY)}){NAME_END}{REST_OF_TAG}|[a-zA-Z]{REST_OF_TAG}(?<=/>))"
    plain = rf"<(?:{COMMENT}|{CODE}|[!?][^>]*+>|{alone})"
    within = rf"(?:[^<]++|{plain})"
    for group in range(1, _INERT_DEPTH + 1):
        name = f"n{group}"
        whole = (
            rf"<{other}(?<{name}>[a-zA-Z][^\s/>\"'<]*+)(?=[\s/>]){REST_OF_TAG}(?<!/>)"
            rf"{within}*+</(?i:\k<{name}>)(?=[\s/>]){REST_OF_TAG}(?<!/>)"
        )
        within = rf"(?:[^<]++|{whole}|{plain})"
    return rf"{within}++|</?[a-zA-Z]{REST_OF_TAG}|<"


_NEAR = 8  # elements after another that are looked at first
_OPEN = "array<struct<name: string, at: int, kind: int>>"
_FOUND = "array<struct<first: int, last: int, kind: int, closed: boolean>>"


def tokens(html):
    """The HTML in pieces whose concatenation it is; none for null."""
    pieces = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))
    return F.coalesce(pieces, F.array().cast("array<string>"))


def elements(pieces, kinds):
    """Wanted elements of tokens, in document order: (`first`, `last`, `kind`, `closed`).

    `pieces` names the column of the tokens. `kinds` lists (tag, class or None); `kind` is the place in
    that list of the first that fits. `first` and `last` number the opening token and the last token
    within, or the closing one. An element that no closing tag of its own ends (`closed` is false)
    ends with its parent, or before the next one of its kind that opens within it.
    """
    return F.expr(_elements(pieces, kinds))


def inner_html(html, tag, css_class=None):
    """The HTML within every such element of the named column, in document order; null for null.

    Runs that cannot change what is open are pieces as a whole, so that few are walked through.
    """
    return F.expr(f"""
        transform(array(regexp_extract_all({html}, {sql_text(_coarse_token(tag))}, 0)), pieces ->
            transform({_elements("pieces", [(tag, css_class)])}, own -> array_join(slice(
                pieces, own.first + 2,
                greatest(own.last - own.first - cast(own.closed AS int), 0)), '')))[0]
    """)


def _elements(pieces, kinds):
    end = f"size({pieces}) - 1"
    return f"""
        transform(array(array_sort(
            aggregate(
                transform(array({_marks(pieces, kinds)}), marks -> {_WITHOUT_LEAVES})[0],
                named_struct('open', cast(array() AS {_OPEN}), 'found', cast(array() AS {_FOUND})),
                (state, mark) -> {_STEP},
                state -> concat(state.found, {_found("state.open", end, end, "-1")})
            ))), found -> {_UNTIL_NEXT})[0]
    """


def _marks(pieces, kinds):
    """What each tag opens or closes, without empty elements that are not wanted."""
    whens = ""
    for place, (tag, css_class) in enumerate(kinds):
        pattern = sql_text("^" + opening_pattern(tag, css_class))
        own = "" if css_class is None else f" AND rlike(piece, {pattern})"
        whens += f" WHEN name = {sql_text(tag)}{own} THEN {place}"
    return f"""
        filter(
            transform({pieces}, (piece, at) -> CASE WHEN startswith(piece, '<') AND rlike(piece, {sql_text(_ONE_TAG)}) THEN
                transform(array(lower(regexp_extract(piece, {sql_text(_NAME)}, 1))), name ->
                    CASE WHEN name <> '' AND (name NOT IN ('script', 'style') OR startswith(piece, '</'))
                    THEN named_struct(
                        'name', name, 'at', at, 'opens', NOT startswith(piece, '</'),
                        'kind', CASE WHEN startswith(piece, '</') THEN -1{whens} ELSE -1 END,
                        'alone', rlike(piece, {sql_text(_ALONE)})) END)[0] END),
            mark -> mark IS NOT NULL AND NOT (mark.alone AND mark.kind < 0))
    """


def _leaf(opened, closed):
    """Whether two neighbours are an unwanted element that holds no element: it nests nothing."""
    return (
        f"coalesce({opened}.opens AND NOT {closed}.opens AND {opened}.name = {closed}.name "
        f"AND {opened}.kind < 0, false)"
    )


_WITHOUT_LEAVES = f"""
    filter(marks, (mark, k) ->
        NOT {_leaf("mark", "get(marks, k + 1)")} AND NOT {_leaf("get(marks, k - 1)", "mark")})
"""


def _found(ended, last, last_within, own):
    """The wanted of elements that have ended; the one that opens at `own` by its closing tag."""
    return f"""
        transform(filter({ended}, o -> o.kind >= 0), o -> named_struct(
            'first', o.at, 'last', CASE WHEN o.at = {own} THEN {last} ELSE {last_within} END,
            'kind', o.kind, 'closed', o.at = {own}))
    """


# The state after a tag; a closing one leaves `left` elements open, all of them if none fits.
_LEFT = """
    CASE WHEN element_at(state.open, -1).name = mark.name THEN size(state.open) - 1
    ELSE size(state.open)
         - cast(array_position(reverse(transform(state.open, o -> o.name)), mark.name) AS int) END
"""
_STEP = f"""
    CASE WHEN mark.alone THEN
        named_struct('open', state.open, 'found', concat(state.found, array(named_struct(
            'first', mark.at, 'last', mark.at, 'kind', mark.kind, 'closed', true))))
    WHEN mark.opens THEN
        named_struct('open', concat(state.open, array(named_struct(
            'name', mark.name, 'at', mark.at, 'kind', mark.kind))), 'found', state.found)
    WHEN size(state.open) = 0 THEN state
    ELSE transform(array({_LEFT}), left ->
        transform(array(slice(state.open, left + 1, size(state.open) - left)), ended ->
            named_struct(
                'open', slice(state.open, 1, left),
                'found', CASE WHEN exists(ended, o -> o.kind >= 0) THEN concat(
                    state.found, {_found("ended", "mark.at", "mark.at - 1", "ended[0].at")})
                    ELSE state.found END))[0])[0]
    END
"""


def _next_of(found, k, kind, last):
    """The first element of a kind after the k-th that opens before token `last`; null if none does.

    Most lie close by, so that few are looked at.
    """
    near = f"get(filter(slice({found}, {k} + 2, {_NEAR}), n -> n.kind = {kind} AND n.first <= {last}), 0)"
    far = (
        f"get(filter(slice({found}, {k} + {_NEAR + 2}, size({found})), "
        f"n -> n.kind = {kind} AND n.first <= {last}), 0)"
    )
    beyond = f"get({found}, {k} + {_NEAR + 1}).first <= {last}"
    return f"coalesce({near}, CASE WHEN {beyond} THEN {far} END)"


_UNTIL_NEXT = f"""
    transform(found, (own, k) -> named_struct(
        'first', own.first,
        'last', CASE WHEN own.closed THEN own.last ELSE
            coalesce({_next_of("found", "k", "own.kind", "own.last")}.first - 1, own.last) END,
        'kind', own.kind, 'closed', own.closed))
"""


def inner(pieces, element):
    """The tokens within an element of theirs."""
    end = F.when(element["closed"], element["last"]).otherwise(element["last"] + 1)
    first = element["first"] + 1  # counted from 0, as against the positions of a slice
    return F.slice(pieces, first + 1, F.greatest(end - first, F.lit(0)))


def text(pieces):
    """The text of tokens, references not yet decoded."""
    return F.array_join(F.filter(pieces, lambda piece: ~piece.rlike(_MARKUP)), "")
