"""Named SQL steps; `with_steps` puts together the ones a query needs."""

from __future__ import annotations

import re

from formsift import constants as K
from formsift.sources import forms as S

WS = K.SPACE
D = K.DIGIT
# no look-ahead in this dialect: the ZIP is group 1, what may follow it is spelled out
ZIP = rf"\b({D}{{5}}(?:-{D}{{4}})?)(?:$|[^\w-]|-(?:[^0-9]|$))"
# nor look-around for the ends of words
ZIP_PLAIN = rf"\b{D}{{5}}(?:-{D}{{4}})?\b"
PERSONAL_ID = rf"\b{D}{{3}}-{D}{{2}}-{D}{{4}}\b"
EMPLOYER_ID = rf"\b{D}{{2}}-{D}{{7}}\b"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


STATES = listed(K.STATES)
TRIM_SET = " || ".join(f"chr({ord(c)})" for c in K.SPACE_CHARS)


def strip(x: str) -> str:
    return f"trim({x}, {TRIM_SET})"


def single(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def squeeze(x: str) -> str:
    return f"nullif({single(x)}, '')"


def squeeze_or_null_word(x: str) -> str:
    return f"(CASE WHEN lower({squeeze(x)}) NOT IN ({listed(K.NULL_WORDS)[1:-1]}) THEN {squeeze(x)} END)"


def alnum(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"


def alnum_for_compare(x: str) -> str:
    bare = f"lower({strip(f'coalesce({x}, {quoted(str())})')})"
    return f"(CASE WHEN {bare} IN ({listed(K.BLANK_WORDS)[1:-1]}) THEN '' ELSE {alnum(x)} END)"


def tokens(x: str) -> str:
    return f"regexp_split_to_array({x}, '{WS}+')"


def drop_initials(x: str) -> str:
    kept = f"list_filter(string_split({squeeze(x)}, ' '), lambda t: NOT regexp_full_match(trim(t, '. '), '\\p{{L}}'))"
    return f"(CASE WHEN len({kept}) = 0 THEN {squeeze(x)} ELSE array_to_string({kept}, ' ') END)"


def swap(x: str) -> str:
    parts = f"string_split({drop_initials(x)}, ' ')"
    return f"(CASE WHEN len({parts}) = 2 THEN {parts}[2] || ' ' || {parts}[1] ELSE {drop_initials(x)} END)"


def order_name(x: str, context: str) -> str:
    last, first = f"strpos({context}, 'last name')", f"strpos({context}, 'employee''s first name')"
    return (
        f"(CASE WHEN {last} > 0 AND {first} > 0 AND {last} < {first} THEN {swap(x)} ELSE {drop_initials(x)} END)"
    )


def street_key(x: str) -> str:
    words = f"regexp_extract_all(lower({x}), '[a-z0-9]+')"
    return f"(CASE WHEN len({words}) >= 2 THEN {words}[1] || '_' || {words}[2] END)"


def fixed(x: str, places: int) -> str:
    return f"printf('%.{places}f', {x})"


def rounded(x: str, places: int) -> str:
    return f"CAST({fixed(x, places)} AS DOUBLE)"


def number_text(x: str, places: int) -> str:
    return f"CAST({rounded(x, places)} AS VARCHAR)"


def percent_text(x: str) -> str:
    return f"({fixed(f'({x}) * 100', 2)} || '%')"


def words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z]+')"


def address_word(x: str, among: list[str] = K.ADDRESS_WORDS) -> str:
    return f"list_has_any({words(x)}, {listed(among)})"


def company(x: str, among: list[str] = K.COMPANY_WORDS) -> str:
    return f"(contains(lower({x}), ' and sons') OR list_has_any({words(x)}, {listed(among)}))"


def street_number(x: str) -> str:
    return f"regexp_matches({x}, '^{D}{{1,6}}{WS}+[A-Za-z]')"


def street(x: str) -> str:
    return f"({street_number(x)} AND {address_word(x)})"


def number(x: str) -> str:
    return f"regexp_full_match({x}, '{D}+(\\.{D}+)?')"


def code(x: str) -> str:
    return f"({x} IN ({listed(K.CHECKBOX_MARKS)[1:-1]}) OR regexp_full_match({x}, '{D}+[a-zA-Z]?'))"


def state(x: str) -> str:
    return f"list_contains({STATES}, {x})"


def has_state(x: str) -> str:
    return f"list_has_any({tokens(x)}, {STATES})"


def zip_line(x: str) -> str:
    return f"regexp_full_match({x}, '{D}{{5}}(-{D}{{4}})?')"


def zip_in(x: str) -> str:
    return f"nullif(regexp_extract({x}, '{ZIP}', 1), '')"


def has_zip(x: str) -> str:
    return f"regexp_matches({x}, '{ZIP}')"


def any_phrase(x: str, phrases: list[str]) -> str:
    return f"(len(list_filter({listed(phrases)}, lambda q: contains({x}, q))) > 0)"


def ignored(x: str) -> str:
    return f"list_contains({listed(K.IGNORED_WORDS)}, lower({x}))"


def label(x: str) -> str:
    return f"({ignored(x)} OR {any_phrase(f'lower({x})', K.LABEL_KEYWORDS)})"


def title(x: str) -> str:
    bare = f"trim({x}, '. ')"
    return (
        f"(regexp_full_match({bare}, '[A-Za-z][A-Za-z.''-]*') AND regexp_matches({bare}, '^[A-Z]')"
        f" AND {bare} <> upper({bare}))"
    )


def possible_name(x: str) -> str:
    return (
        f"(NOT {label(x)} AND NOT {number(x)} AND NOT {code(x)} AND NOT {state(x)} AND NOT {zip_line(x)}"
        f" AND NOT {street(x)} AND regexp_full_match({x}, '[A-Za-z][A-Za-z .''-]*'))"
    )


def single_name(x: str) -> str:
    """For a squeezed line."""
    letters = f"regexp_replace({x}, '[^A-Za-z]', '', 'g')"
    return (
        f"(NOT contains({x}, ' ') AND NOT {label(x)} AND NOT {number(x)} AND NOT {code(x)} AND NOT {state(x)}"
        f" AND NOT {zip_line(x)} AND NOT {street(x)} AND len({letters}) >= 2 AND {letters} <> upper({letters})"
        f" AND {title(x)})"
    )


def full_name(x: str) -> str:
    """For a squeezed line."""
    bad = (
        f"list_filter(string_split({x}, ' '), lambda t: regexp_full_match(trim(t, '. '), '\\p{{L}}')"
        f" OR {ignored("trim(t, '. ')")} OR NOT {title('t')})"
    )
    return (
        f"(len(string_split({x}, ' ')) = 2 AND NOT {label(x)} AND NOT {has_state(x)} AND NOT {has_zip(x)}"
        f" AND NOT {street(x)} AND len({bad}) = 0)"
    )


def count_literal(text: str, needle: str) -> str:
    return f"CAST(coalesce((len({text}) - len(replace({text}, {needle}, ''))) // nullif(len({needle}), 0), 0) AS INTEGER)"


def count_word(text: str, needle: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '\\b' || regexp_escape({needle}) || '\\b')) AS INTEGER)"


# --- address parts of one line -------------------------------------------------------------------

ZIP_TOKEN = f"list_position(list_transform({tokens('line')}, lambda t: {has_zip('t')}), true)"
A1_STATE = (
    f"(CASE WHEN {ZIP_TOKEN} > 1 AND list_contains({STATES}, {tokens('line')}[{ZIP_TOKEN} - 1])"
    f" THEN {tokens('line')}[{ZIP_TOKEN} - 1] END)"
)
A1_CITY = (
    f"(CASE WHEN {A1_STATE} IS NOT NULL THEN"
    f" nullif(array_to_string({tokens('line')}[1:{ZIP_TOKEN} - 2], ' '), '') END)"
)
ENDS_IN_STATE = f"(len({tokens('line')}) >= 2 AND list_contains({STATES}, {tokens('line')}[-1]))"
A2_CITY = f"(CASE WHEN {ENDS_IN_STATE} THEN array_to_string({tokens('line')}[1:-2], ' ') END)"
A2_STATE = f"(CASE WHEN {ENDS_IN_STATE} THEN {tokens('line')}[-1] END)"

# --- validation ----------------------------------------------------------------------------------

STATE_ZIP = rf"\b({'|'.join(K.STATES)})\b{WS}+({ZIP_PLAIN})"


def valid_name(x: str) -> str:
    parts = f"string_split({x}, ' ')"
    bare = f"list_filter(list_transform({parts}, lambda t: trim(t, '.''- ')), lambda t: len(t) > 1)"
    wrong = f"list_filter({bare}, lambda t: NOT regexp_full_match(t, '[A-Za-z][A-Za-z.''-]*') OR t = upper(t))"
    return (
        f"coalesce(NOT {company(x, K.VALID_COMPANY_WORDS)} AND NOT {any_phrase(f'lower({x})', K.BAD_NAME_TERMS)}"
        f" AND len({parts}) BETWEEN 2 AND 4 AND len({bare}) >= 2 AND len({wrong}) = 0, false)"
    )


def state_zip(x: str, group: int) -> str:
    return f"nullif(regexp_extract({x}, '{STATE_ZIP}', {group}), '')"


def valid_address(x: str) -> str:
    return (
        f"coalesce({street_number(x)} AND {address_word(x, K.VALID_ADDRESS_WORDS)}"
        f" AND regexp_matches({x}, '{STATE_ZIP}') AND len(regexp_extract_all({x}, '[A-Za-z0-9-]+')) >= 6, false)"
    )


def valid_id(x: str) -> str:
    return f"coalesce(regexp_full_match({x}, '{D}{{3}}-{D}{{2}}-{D}{{4}}'), false)"


def name_whole(x: str, text: str) -> str:
    return count_literal(alnum(text), alnum(x))


def name_outer(x: str, text: str) -> str:
    parts = f"string_split({alnum(x)}, ' ')"
    return (
        f"(CASE WHEN len({parts}) < 2 THEN 0 ELSE least({count_word(alnum(text), f'{parts}[1]')},"
        f" {count_word(alnum(text), f'{parts}[-1]')}) END)"
    )


def confidence(valid: str, seen: str) -> str:
    return f"CAST(CASE WHEN NOT {valid} THEN 0.0 WHEN {seen} >= 2 THEN 0.95 ELSE 0.9 END AS DOUBLE)"


# --- comparison ----------------------------------------------------------------------------------

def state_for_compare(x: str) -> str:
    found = f"list_filter(list_transform({tokens(f"replace({x}, ',', ' ')")}, lambda t: upper(t)), lambda t: list_contains({STATES}, t))"
    return f"coalesce({found}[1], '')"


def zip_for_compare(x: str) -> str:
    return f"coalesce(regexp_extract({x}, '{ZIP_PLAIN}'), '')"


def shared_characters(a: str, b: str) -> str:
    times = "least(" + ", ".join(f"len({x}) - len(replace({x}, c, ''))" for x in (a, b)) + ")"
    return f"list_sum(list_transform(list_distinct(string_split({a}, '')), lambda c: {times}))"


def share(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0), CAST(0 AS DOUBLE))"


def kind_any_case(x: str) -> str:
    return f"(CASE WHEN lower({x}) LIKE '%clean%' THEN 'clean' WHEN lower({x}) LIKE '%noisy%' THEN 'noisy' ELSE 'unknown' END)"


def kind_cased(x: str) -> str:
    return f"(CASE WHEN {x} LIKE '%clean%' THEN 'clean' WHEN {x} LIKE '%noisy%' THEN 'noisy' ELSE 'unknown' END)"


def _split(source: str, key: str, text: str) -> str:
    return f"""
SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS line_no, line
FROM (SELECT id, {strip('part')} AS line, i
      FROM (SELECT {key} AS id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
            FROM (SELECT {key}, regexp_split_to_array(coalesce({text}, ''), '{K.LINE_BREAK}') AS parts FROM {source})))
WHERE line <> ''"""


FLAGS = f"""
  {number('line')} AS number, {code('line')} AS code, {state('line')} AS state, {has_state('line')} AS has_state,
  {zip_line('line')} AS zip_line, {has_zip('line')} AS has_zip, {zip_in('line')} AS zip, {street('line')} AS street,
  {label('line')} AS label, {ENDS_IN_STATE} AS ends_in_state, regexp_matches(line, '[A-Za-z]') AS letter,
  {single_name(single('line'))} AS single_name, {full_name(single('line'))} AS full_name"""

STEPS = {
    "forms": "SELECT *, make_timestamp(processed_second * 1000000) AS processed_at FROM ("
    + S.forms_sql(S.pick_list, "customer", "supplier") + ")",
    "truth": S.truth_sql(S.pick_list, "forms"),
    "prior": S.prior_sql("forms"),
    "form_lines": _split("forms", "k", "raw_text"),
    "document_lines": _split("documents", "doc_id", "text"),
    "all_lines": "SELECT 'form' AS source, id, line_no, line FROM form_lines UNION ALL"
    " SELECT 'document', id, line_no, line FROM document_lines",
    "flagged": f"SELECT id AS k, line_no, line, {FLAGS} FROM form_lines",
    "anchors": f"""
SELECT k, min(line_no) FILTER (contains(line, {quoted(K.EMPLOYER_ANCHOR)})) AS employer_start,
  min(line_no) FILTER (contains(line, {quoted(K.EMPLOYEE_ANCHOR)})) AS employee_start
FROM (SELECT f.k, line_no, line FROM forms f LEFT JOIN flagged l ON l.k = f.k) GROUP BY k""",
    "bounds": f"""
SELECT a.k, any_value(employer_start) AS employer_start, any_value(employee_start) AS employee_start,
  min(line_no) FILTER (line_no > employer_start AND
    (contains(line, {quoted(K.EMPLOYER_STOPS[0])}) OR contains(line, {quoted(K.EMPLOYER_STOPS[1])}))) AS employer_stop,
  min(line_no) FILTER (line_no > employee_start AND contains(line, {quoted(K.EMPLOYEE_END)})) AS employee_stop
FROM anchors a JOIN flagged f ON f.k = a.k GROUP BY a.k""",
    "block_lines": """
SELECT f.*, 'employer' AS mode FROM flagged f JOIN bounds b ON f.k = b.k
WHERE line_no > employer_start AND (employer_stop IS NULL OR line_no < employer_stop)
UNION ALL
SELECT f.*, 'block' AS mode FROM flagged f JOIN bounds b ON f.k = b.k
WHERE line_no > employee_start AND line_no < coalesce(employee_stop, employee_start + 45)""",
    "useful_lines": """
SELECT *, row_number() OVER (PARTITION BY k, mode ORDER BY line_no) - 1 AS pos
FROM block_lines WHERE NOT number AND NOT code AND NOT label""",
    "mode_lines": "SELECT *, 'full' AS mode, line_no AS pos FROM flagged UNION ALL SELECT * FROM useful_lines",
    "streets": "SELECT k, mode, pos, line AS street FROM mode_lines WHERE street",
    "ahead": f"""
SELECT s.k, s.mode, s.pos, s.street AS street_line, l.pos - s.pos AS off, l.* EXCLUDE (k, mode, pos),
  l.letter AND NOT l.state AND NOT l.has_zip AND NOT l.label AND NOT l.street AS before_ok,
  l.letter AND NOT l.state AND NOT l.has_zip AND NOT l.label AND NOT l.street
    AND NOT l.number AND NOT l.code AS after_ok
FROM streets s JOIN mode_lines l ON l.k = s.k AND l.mode = s.mode AND l.pos BETWEEN s.pos + 1 AND s.pos + 11""",
    "fired": """
SELECT s.k, s.mode, s.pos, any_value(s.street) AS street_line,
  min(off) FILTER (has_state AND has_zip) AS r1, min(off) FILTER (ends_in_state) AS r2,
  min(off) FILTER (state) AS r3, min(off) FILTER (zip_line) AS r4
FROM streets s LEFT JOIN ahead a ON a.k = s.k AND a.mode = s.mode AND a.pos = s.pos GROUP BY s.k, s.mode, s.pos""",
    "parts": f"""
SELECT f.k, f.mode, f.pos, any_value(f.street_line) AS street_line,
  any_value(r1) AS r1, any_value(r2) AS r2, any_value(r3) AS r3, any_value(r4) AS r4,
  any_value({A1_CITY}) FILTER (off = r1) AS city1, any_value({A1_STATE}) FILTER (off = r1) AS state1,
  any_value(zip) FILTER (off = r1) AS zip1,
  arg_max(line, off) FILTER (off < r1 AND before_ok) AS before1,
  arg_min(line, off) FILTER (off > r1 AND after_ok) AS after1,
  any_value({A2_CITY}) FILTER (off = r2) AS city2, any_value({A2_STATE}) FILTER (off = r2) AS state2,
  arg_min(zip, off) FILTER (off > r2 AND has_zip) AS zip2,
  any_value(line) FILTER (off = r3) AS state3,
  arg_max(line, off) FILTER (off < r3 AND before_ok) AS before3,
  arg_min(line, off) FILTER (off > r3 AND after_ok) AS after3,
  arg_min(zip, off) FILTER (off > r3 AND has_zip) AS zip3,
  any_value(line) FILTER (off = r4) AS zip4
FROM fired f LEFT JOIN ahead a ON a.k = f.k AND a.mode = f.mode AND a.pos = f.pos GROUP BY f.k, f.mode, f.pos""",
    "assembled": f"""
SELECT k, mode, pos, {street_key('street_line')} AS street_key, {single('''CASE
    WHEN r1 IS NOT NULL THEN concat_ws(' ', street_line, coalesce(city1, before1, after1), state1, zip1)
    WHEN r2 IS NOT NULL THEN concat_ws(' ', street_line, city2, state2, zip2)
    WHEN r3 IS NOT NULL THEN concat_ws(' ', street_line, coalesce(before3, after3), state3, zip3)
    WHEN r4 IS NOT NULL THEN concat_ws(' ', street_line, zip4)
    ELSE street_line END''')} AS address
FROM parts""",
    "graded": f"""
SELECT *, CAST(CASE WHEN {street('address')} THEN 10 ELSE 0 END + CASE WHEN {has_state('address')} THEN 20 ELSE 0 END
  + CASE WHEN {has_zip('address')} THEN 25 ELSE 0 END AS INTEGER) AS quality FROM assembled""",
    "best_address": """
SELECT k, mode, street_key, quality, address FROM (
  SELECT *, row_number() OVER (PARTITION BY k, mode, street_key ORDER BY quality DESC, pos) AS rn
  FROM graded WHERE street_key IS NOT NULL) WHERE rn = 1""",
    "upgraded": """
SELECT g.k, g.mode, g.pos, CASE WHEN b.quality > g.quality THEN b.address ELSE g.address END AS address
FROM graded g LEFT JOIN best_address b ON b.k = g.k AND b.mode = g.mode AND b.street_key = g.street_key""",
    "back": """
SELECT s.k, s.mode, s.pos, arg_max(l.line, l.pos) FILTER (full_name) AS full_line,
  list(l.pos ORDER BY l.pos DESC) FILTER (single_name) AS single_pos,
  list(l.line ORDER BY l.pos DESC) FILTER (single_name) AS single_line,
  coalesce(lower(string_agg(l.line, ' ' ORDER BY l.pos)), '') AS context
FROM streets s LEFT JOIN mode_lines l ON l.k = s.k AND l.mode = s.mode AND l.pos BETWEEN s.pos - 15 AND s.pos - 1
GROUP BY s.k, s.mode, s.pos""",
    "raw_names": """
SELECT k, mode, pos, context, CASE WHEN full_line IS NOT NULL THEN full_line
  WHEN len(single_pos) >= 2 AND single_pos[1] - single_pos[2] - 1 <= 5 THEN single_line[2] || ' ' || single_line[1]
  END AS raw_name FROM back""",
    "names": f"""
SELECT k, mode, pos, CASE WHEN raw_name IS NOT NULL THEN {order_name('raw_name', 'context')} END AS name FROM raw_names""",
    "contexts": """
SELECT s.k, s.mode, s.pos,
  contains(t, 'employee') OR contains(t, 'last name') AS has_employee, contains(u, 'employer') AS has_employer
FROM (SELECT s.k, s.mode, s.pos, lower(string_agg(l.line, ' ' ORDER BY l.pos)) AS t,
        lower(string_agg(l.line, ' ' ORDER BY l.pos) FILTER (l.pos >= s.pos - 15)) AS u
      FROM streets s JOIN mode_lines l ON l.k = s.k AND l.mode = s.mode AND l.pos BETWEEN s.pos - 25 AND s.pos + 4
      GROUP BY s.k, s.mode, s.pos) s""",
    "mode_text": """
SELECT k, mode, lower(string_agg(line, ' ' ORDER BY pos)) AS text FROM mode_lines GROUP BY k, mode""",
    "pairs": """
SELECT n.k, n.mode, n.pos, n.name, u.address, c.has_employee, c.has_employer
FROM names n JOIN upgraded u ON u.k = n.k AND u.mode = n.mode AND u.pos = n.pos
JOIN contexts c ON c.k = n.k AND c.mode = n.mode AND c.pos = n.pos
WHERE n.name IS NOT NULL AND n.mode <> 'employer'""",
    "repeated": f"""
SELECT p.*, CAST(CASE WHEN len(string_split(name, ' ')) < 2 THEN 0
  WHEN {count_word('text', 'lower(name)')} > 0 THEN {count_word('text', 'lower(name)')}
  ELSE least({count_word('text', "string_split(lower(name), ' ')[1]")},
             {count_word('text', "string_split(lower(name), ' ')[-1]")}) END AS INTEGER) AS repeats
FROM pairs p JOIN mode_text t ON t.k = p.k AND t.mode = p.mode""",
    "scored": f"""
SELECT k, mode, pos, {drop_initials('name')} AS name, address, has_employee, has_employer, repeats,
  CAST(40
  + CASE WHEN {has_state('address')} THEN 15 ELSE 0 END + CASE WHEN {has_zip('address')} THEN 20 ELSE 0 END
  + CASE WHEN has_employee THEN 25 ELSE 0 END - CASE WHEN has_employer THEN 35 ELSE 0 END
  + CASE WHEN {full_name(single('name'))} THEN 10 ELSE 0 END
  + CASE WHEN repeats >= 2 THEN 45 WHEN repeats = 1 THEN 5 ELSE 0 END
  - CASE WHEN {any_phrase('lower(name)', K.BAD_NAME_TERMS)} THEN 120 ELSE 0 END
  - CASE WHEN regexp_matches(name, '[A-Z]') AND NOT regexp_matches(name, '[a-z]') THEN 100 ELSE 0 END
  - CASE WHEN len(string_split(name, ' ')) >= 2 AND len(string_split(name, ' ')[1]) <= 2 THEN 35 ELSE 0 END
  - CASE WHEN {company('name')} THEN 120 ELSE 0 END AS INTEGER) AS score
FROM repeated""",
    "best": f"""
SELECT k, mode, pos, score, name, address FROM (
  SELECT *, row_number() OVER (PARTITION BY k, mode
    ORDER BY score DESC, {has_state('address')} DESC, {has_zip('address')} DESC, pos) AS rn FROM scored)
WHERE rn = 1""",
    "form_text": """
SELECT k, lower(string_agg(line, ' ' ORDER BY line_no)) AS text FROM flagged GROUP BY k""",
    "merged": """
SELECT f.k, b.name AS block_name, b.address AS block_address,
  CASE WHEN b.name IS NULL OR b.address IS NULL THEN w.name END AS full_name,
  CASE WHEN b.name IS NULL OR b.address IS NULL THEN w.address END AS full_address
FROM forms f LEFT JOIN best b ON b.k = f.k AND b.mode = 'block' LEFT JOIN best w ON w.k = f.k AND w.mode = 'full'""",
    "employee": f"""
SELECT m.k, CASE WHEN coalesce(block_name, full_name) IS NOT NULL
    THEN {order_name('coalesce(block_name, full_name)', 't.text')} END AS employee_name,
  coalesce(block_address, full_address) AS employee_address
FROM merged m LEFT JOIN form_text t ON t.k = m.k""",
    "employer": f"""
SELECT f.k, n.name AS employer_name, g.address AS employer_address
FROM forms f
LEFT JOIN (SELECT k, {squeeze('arg_min(line, pos)')} AS name FROM useful_lines
           WHERE mode = 'employer' AND letter AND NOT street GROUP BY k) n ON n.k = f.k
LEFT JOIN (SELECT k, arg_min(address, pos) AS address FROM graded WHERE mode = 'employer' GROUP BY k) g ON g.k = f.k""",
    "extracted": f"""
SELECT f.k, f.file_name, f.raw_text, f.error, f.processed_at, f.processing_time_seconds,
  e.employee_name, e.employee_address,
  nullif(regexp_extract(raw_text, '{PERSONAL_ID}'), '') AS employee_ssn,
  r.employer_name, r.employer_address,
  nullif(regexp_extract(raw_text, '{EMPLOYER_ID}'), '') AS employer_ein
FROM forms f JOIN employee e ON e.k = f.k JOIN employer r ON r.k = f.k""",
    "valid": f"""
SELECT *, {valid_name('name2')} AS name_ok, {valid_address('address2')} AS address_ok, {valid_id('id2')} AS id_ok
FROM (SELECT *, coalesce(raw_text, '') AS body, {squeeze_or_null_word('employee_name')} AS name2,
        {squeeze_or_null_word('employee_address')} AS address2, {squeeze_or_null_word('employee_ssn')} AS id2
      FROM extracted)""",
    "seen": f"""
SELECT *,
  CASE WHEN NOT name_ok THEN NULL WHEN {name_whole('name2', 'body')} > 0 THEN {name_whole('name2', 'body')}
       ELSE {name_outer('name2', 'body')} END AS name_seen,
  CASE WHEN address_ok THEN least({count_word('body', f"regexp_extract(address2, '^{D}{{1,6}}')")},
                                  {count_literal('body', state_zip('address2', 2))}) END AS address_seen,
  CASE WHEN id_ok THEN {count_literal('body', 'id2')} END AS id_seen
FROM valid""",
    "rated": f"""
SELECT *, {confidence('name_ok', 'name_seen')} AS name_confidence,
  {confidence('address_ok', 'address_seen')} AS address_confidence, {confidence('id_ok', 'id_seen')} AS id_confidence
FROM seen""",
    "judged": """
SELECT *, (name_confidence + address_confidence + id_confidence) / 3 AS overall_confidence,
  concat_ws(', ', CASE WHEN name_confidence < 0.9 THEN 'employee_name' END,
    CASE WHEN address_confidence < 0.9 THEN 'employee_address' END,
    CASE WHEN id_confidence < 0.9 THEN 'employee_ssn' END) AS failing
FROM rated""",
    "validated": f"""
SELECT *, CASE WHEN failing = '' AND overall_confidence >= CAST(0.9 AS DOUBLE) THEN 'AUTO_APPROVED' ELSE 'NEEDS_REVIEW' END AS status,
  CASE WHEN failing <> '' THEN '{K.REASON_MISSING}' || failing
    WHEN overall_confidence < CAST(0.9 AS DOUBLE) THEN '{K.REASON_OVERALL}'
    ELSE '{K.REASON_COMPLETE}' || 'Repeat evidence - name: ' || name_seen || ', address: ' || address_seen
         || ', SSN: ' || id_seen || '.' END AS review_reason
FROM judged""",
    "results": "SELECT processed_at, processing_time_seconds, file_name, " + kind_any_case("file_name") + " AS file_type, "
    + ", ".join(f"CASE WHEN error IS NULL THEN {c} END AS {c}" for c in K.FIELDS) + ", "
    + ", ".join(f"CASE WHEN error IS NULL THEN {c} ELSE CAST(0 AS DOUBLE) END AS {c}" for c in K.CONFIDENCES)
    + ", CASE WHEN error IS NULL THEN status ELSE 'FAILED' END AS status,"
    " coalesce(error, review_reason) AS review_reason FROM validated",
    "joined": "SELECT t.file_name, t.file_type, t.employee_name, t.employee_address, t.employee_ssn, "
    + ", ".join(f"coalesce(r.{c}, '') AS got_{c}" for c in K.CHECKED_FIELDS)
    + ", coalesce(r.status, '') AS status, coalesce(r.review_reason, '') AS review_reason"
    " FROM truth t LEFT JOIN results r ON r.file_name = t.file_name",
    "unpivoted": " UNION ALL ".join(
        f"SELECT file_name, file_type, '{c}' AS field_name, coalesce({c}, '') AS expected_value,"
        f" got_{c} AS extracted_value, status, review_reason FROM joined"
        for c in K.CHECKED_FIELDS
    ),
    # NULL where the ratio decides: neither equality, state, ZIP nor the characters that both sides hold do
    "compared": f"""
SELECT *, CASE WHEN want = 'NOT_VERIFIABLE' THEN 'Not Verifiable' WHEN a = b THEN 'Pass'
    WHEN a = '' OR b = '' OR field_name <> 'employee_address' THEN 'Fail'
    WHEN {state_for_compare('want')} <> {state_for_compare('have')} OR {zip_for_compare('want')} <> {zip_for_compare('have')} THEN 'Fail'
    WHEN 2.0::DOUBLE * {shared_characters('a', 'b')} / (len(a) + len(b)) < 0.9 THEN 'Fail' END AS known
FROM (SELECT *, {strip('expected_value')} AS want, {strip('extracted_value')} AS have,
        {alnum_for_compare('expected_value')} AS a, {alnum_for_compare('extracted_value')} AS b FROM unpivoted)""",
    # Every range of both values gives its longest common piece, then the ranges left and right of it. A piece is a
    # run of equal characters on one diagonal. Values of 200 characters or more, which the forms lack, need more rules.
    "ranges": """
SELECT DISTINCT a, b, 0::BIGINT AS a_low, len(a) AS a_high, 0::BIGINT AS b_low, len(b) AS b_high, 0::BIGINT AS got
FROM compared WHERE known IS NULL
UNION ALL
SELECT a, b, CASE WHEN side = 1 THEN a_low ELSE piece.i + piece.size END, CASE WHEN side = 1 THEN piece.i ELSE a_high END,
  CASE WHEN side = 1 THEN b_low ELSE piece.j + piece.size END, CASE WHEN side = 1 THEN piece.j ELSE b_high END,
  CASE WHEN side = 1 THEN piece.size ELSE 0 END
FROM (SELECT a, b, a_low, a_high, b_low, b_high, unnest([1, 2]) AS side,
    first({'size': size, 'i': i, 'j': j} ORDER BY size DESC, i, j) AS piece
  FROM (SELECT a, b, a_low, a_high, b_low, b_high, count(*) AS size, min(i) AS i, min(j) AS j
    FROM (SELECT *, i - row_number() OVER (PARTITION BY a, b, a_low, a_high, b_low, b_high, i - j ORDER BY i) AS run
      FROM (SELECT *, unnest(range(b_low, b_high)) AS j FROM (SELECT *, unnest(range(a_low, a_high)) AS i FROM ranges))
      WHERE substr(a, i + 1, 1) = substr(b, j + 1, 1))
    GROUP BY a, b, a_low, a_high, b_low, b_high, i - j, run)
  GROUP BY a, b, a_low, a_high, b_low, b_high)""",
    "ratios": "SELECT a, b, 2.0::DOUBLE * sum(got)::DOUBLE / (len(a) + len(b)) AS ratio FROM ranges GROUP BY a, b",
    "checks": """
SELECT c.file_name, c.file_type, c.field_name, c.expected_value, c.extracted_value, c.status, c.review_reason,
  coalesce(c.known, CASE WHEN r.ratio >= 0.9 THEN 'Pass' ELSE 'Fail' END) AS result
FROM compared c LEFT JOIN ratios r ON c.a = r.a AND c.b = r.b""",
    "accuracy": """
SELECT count(DISTINCT file_name) AS files, count(*) AS checks, count_if(result = 'Pass') AS passed,
  count_if(result = 'Fail') AS failed, count_if(result = 'Not Verifiable') AS open,
  count_if(file_type = 'clean' AND result <> 'Not Verifiable') AS clean,
  count_if(file_type = 'clean' AND result = 'Pass') AS clean_passed,
  count_if(file_type = 'noisy' AND result <> 'Not Verifiable') AS noisy,
  count_if(file_type = 'noisy' AND result = 'Pass') AS noisy_passed,
  count_if(status = 'AUTO_APPROVED' AND result <> 'Not Verifiable') AS approved,
  count_if(status = 'AUTO_APPROVED' AND result = 'Pass') AS approved_passed
FROM checks""",
    "latest_prior": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY seq DESC) AS rn FROM prior) WHERE rn = 1""",
}


def with_steps(select: str) -> str:
    """`select` with the steps it needs, directly or through others, as a WITH clause."""
    needed: set[str] = set()
    text = [select]
    while text:
        used = set(re.findall(r"(?:FROM|JOIN)\s+(\w+)", text.pop(), re.I)) & set(STEPS)
        for name in used - needed:
            needed.add(name)
            text.append(STEPS[name])
    steps = ",\n".join(f"{name} AS ({STEPS[name]})" for name in STEPS if name in needed)
    return f"WITH RECURSIVE {steps}\n{select}" if steps else select
