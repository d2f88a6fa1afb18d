"""Word lists, patterns, windows, scores and messages the results depend on."""

# --- fixed values: words -----------------------------------------------------------------------

STATES = """
AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC
ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC
""".split()

# used while extracting
ADDRESS_WORDS = """
street st road rd avenue ave drive dr lane ln highway hwy throughway throughwa way court ct circle
circles cir suite ste apt apartment plaza plain plains trail trails view views neck shoal shoals
shore shores cliff cliffs mill mills prairie crest stream burg falls lock locks crescent pines brooks
radial islands loop loops extension extensions union unions freeway track tracks point points
""".split()

# used while validating: the same and three more
VALID_ADDRESS_WORDS = ADDRESS_WORDS + ["mission", "spurs", "pine"]

# used while extracting
COMPANY_WORDS = """
llc ltd inc plc group corp corporation company co limited sons industries services associates partners
""".split()

# used while validating: the same without "co"
VALID_COMPANY_WORDS = [word for word in COMPANY_WORDS if word != "co"]

COMPANY_PHRASE = " and sons"

IGNORED_WORDS = """
employee plan retirement retrement statutory stutery satey third-party sick pay last name other see
instructions turbanty tumorang lapaine parures statement safe accurate fast file efile copy wage tax
department treasury internal revenue service www the his cena je mgumu kuniam tigating van ampuni
salle annual sabote wilay ways eade
""".split()

LABEL_KEYWORDS = [
    "employee's social security number", "employer identification number", "wages", "tax withheld",
    "social security", "medicare", "allocated tips", "control number", "advance eic", "dependent care",
    "employee's first name", "last name", "nonqualified plans", "instructions", "statutory",
    "retirement", "third-party", "sick pay", "other", "employee's address", "state", "locality",
    "department of the treasury", "internal revenue service", "form w-2", "statement", "copy", "safe",
    "accurate", "irs", "efile", "omb", "visit", "cut here",
]

BAD_NAME_TERMS = """
efile e-file www statement safe accurate retirement retrement statutory stutery turbanty cena mgumu
kuniam tigating ampuni salle annual sabote wilay ways eade
""".split()

CHECKBOX_MARKS = ["X", "x", "G", "D"]

# words that stand for "no value"
NULL_WORDS = ["none", "null", "nan", "not_verifiable"]
BLANK_WORDS = ["none", "null", "nan"]
NOT_VERIFIABLE = "NOT_VERIFIABLE"

# --- fixed values: anchors ---------------------------------------------------------------------

EMPLOYER_ANCHOR = "Employer's name, address, and ZIP code"
EMPLOYER_STOPS = ["d Control number", "Employee's first name"]
EMPLOYEE_ANCHOR = "Employee's first name and initial"
EMPLOYEE_END = "Employee's address and ZIP code"
LAST_NAME_LABEL = "last name"
FIRST_NAME_LABEL = "employee's first name"

# --- fixed values: windows (lines) -------------------------------------------------------------

LOOK_AHEAD = 11
NAME_LOOK_BACK = 15
EMPLOYEE_CONTEXT = (-25, 4)
EMPLOYER_CONTEXT = (-15, 4)
BLOCK_LINES = 44
NAME_GAP = 5

# --- fixed values: scores, thresholds ----------------------------------------------------------

QUALITY = {"street": 10, "state": 20, "zip": 25}

SCORE = {
    "name": 20, "address": 20, "state": 15, "zip": 20, "employee": 25, "employer": -35,
    "full_name": 10, "evidence_many": 45, "evidence_one": 5, "bad_term": -120, "all_caps": -100,
    "short_first": -35, "company": -120,
}

THRESHOLD = 0.90
CONFIDENCE_REPEATED = 0.95
CONFIDENCE_VALID = 0.90
SIMILARITY = 0.90

# --- fixed values: statuses, messages, column orders -------------------------------------------

AUTO_APPROVED = "AUTO_APPROVED"
NEEDS_REVIEW = "NEEDS_REVIEW"
FAILED = "FAILED"
STATUSES = [AUTO_APPROVED, NEEDS_REVIEW, FAILED]
FILE_TYPES = ["clean", "noisy", "unknown"]

REASON_COMPLETE = "Required customer fields are complete. "
REASON_EVIDENCE = "Repeat evidence - name: %d, address: %d, SSN: %d."
REASON_MISSING = "Missing or incomplete customer field(s): "
REASON_OVERALL = "Overall confidence is below the auto-approval threshold."

FIELDS = [
    "employee_name", "employee_address", "employee_ssn",
    "employer_name", "employer_address", "employer_ein",
]
CHECKED_FIELDS = ["employee_name", "employee_address", "employee_ssn"]
CONFIDENCES = ["name_confidence", "address_confidence", "id_confidence", "overall_confidence"]
VERDICT = CONFIDENCES + ["status", "review_reason"]
RESULT_COLUMNS = ["processed_at", "processing_time_seconds", "file_name", "file_type"] + FIELDS + VERDICT
TEST_RESULT_COLUMNS = ["file_name", "file_type"] + FIELDS + VERDICT
REPORT_COLUMNS = ["file_name", "gcs_uri"] + FIELDS + VERDICT + ["processed_at"]
#: The warehouse table: every column with its type.
TABLE_TYPES = {
    "file_name": "string", "gcs_uri": "string", **dict.fromkeys(FIELDS, "string"), **dict.fromkeys(CONFIDENCES, "double"),
    "status": "string", "review_reason": "string", "processed_at": "timestamp", "raw_text": "string",
}
STATISTICS_COLUMNS = ["section", "file_type", "status", "total", "percentage", "ratio"]

ACCURACY_FORMULA = "Pass / (Pass + Fail), excluding Not Verifiable fields"
PRECISION_FORMULA = "Correct AUTO_APPROVED fields / all AUTO_APPROVED verifiable fields"

# --- patterns ----------------------------------------------------------------------------------
# The forms of ZIP codes, ids and street numbers. Every pattern spells its character classes
# out, word boundaries too, so it means the same for accented or exotic text and on every Java version.

STATE_CODES = "|".join(STATES)

# white space and line breaks as Unicode defines them, with the four ASCII separators
SPACE_SET = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{SPACE_SET}]"
NON_SPACE = f"[^{SPACE_SET}]"
SPACE_CHARS = "".join(
    chr(c) for c in
    [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
     0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
LINE_BREAK = r"[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]+"

DIGIT = r"\p{Nd}"
WORD_BEGIN, WORD_END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
ZIP = rf"{WORD_BEGIN}{DIGIT}{{5}}(?:-{DIGIT}{{4}})?(?!-{DIGIT}){WORD_END}"
ZIP_PLAIN = rf"{WORD_BEGIN}{DIGIT}{{5}}(?:-{DIGIT}{{4}})?{WORD_END}"
PERSONAL_ID = rf"{WORD_BEGIN}{DIGIT}{{3}}-{DIGIT}{{2}}-{DIGIT}{{4}}{WORD_END}"
EMPLOYER_ID = rf"{WORD_BEGIN}{DIGIT}{{2}}-{DIGIT}{{7}}{WORD_END}"
STREET_NUMBER = rf"^{DIGIT}{{1,6}}{SPACE}+[A-Za-z]"
TITLE_WORD = r"[A-Z][A-Z.'-]*[a-z][A-Za-z.'-]*"
