"""Fixed values that results depend on."""

# Characters, patterns and word lists of the method.
MARKS = ("¬", "-", "=")
STRIP_CHARS = ".,;:!?»«„“”\"'()[]*="
LETTERS = "A-Za-zÄÖÜäöüßÀ-ÿ"
TAIL_CHARS = "»«\"')]"
MIN_TOKEN_LEN = 2
ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüß"
SPACE_WORDS = ("geb.", "v.", "gew.", "z.", "(")
STREET_WORDS = ("út", "üt", "ut", "utca")
NEXT_WORD = "^([a-zA-ZäöüÄÖÜßáéíóúÁÉÍÓÚ.]+)"
PAIR_FORMS = ("join", "hyphen", "period", "comma", "split", "skip", "context")
OCCURRENCE_FORMS = ("join", "hyphen", "period", "comma", "split")
SOURCE_RANK = {"manual": 3, "llm": 2, "rule": 1}
LINE_ENDS = {
    "¬": {"join": "¬", "hyphen": "-", "period": ".", "comma": ",", "split": ""},
    "=": {"join": "=", "hyphen": "=", "period": ".", "comma": ",", "split": ""},
}
MARGIN_GATES = (2, 4, 6, 8, 10, 12, 16)

# Thresholds (defaults of the method).
HYPHEN_RATIO, FORM_FLOOR, USUAL_FLOOR = 3.0, 2, 5
TOKEN_MIN_COUNT, TOKEN_RATIO, TOKEN_MIN_LENGTH, TOKEN_MAX_OBSERVED = 20, 50.0, 4, 1
TRUNC_MIN_COUNT, TRUNC_MAX_OBSERVED, TRUNC_MIN_LENGTH, TRUNC_MAX_MISSING, TRUNC_SHOWN, TRUNC_TOP = 10, 1, 3, 1, 3, 3
CONTESTED_FLOOR, AMBIGUOUS_AT, MIN_CANDIDATE, AMBIGUOUS_MIN_LENGTH = 10, 20, 20, 2
BIGRAM_WEIGHT, FLOOR_P, SMOOTHING = 0.99, 1e-12, 0.5
