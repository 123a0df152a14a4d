"""Fixed word tables. All of them can be replaced by the caller."""

# English function words removed by default.
STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves
he him his himself she her hers herself it its itself
they them their theirs themselves
what which who whom this that these those
am is are was were be been being have has had having do does did doing
a an the and but if or because as until while
of at by for with about against between into through during before after
above below to from up down in out on off over under again further
then once here there when where why how all any both each few more most
other some such no nor not only own same so than too very
can will just should now
""".split())

# Contractions rewritten as whole words, in this order.
IRREGULAR_CONTRACTIONS = (
    ("won't", "will not"),
    ("can't", "cannot"),
    ("shan't", "shall not"),
    ("ain't", "are not"),
    ("let's", "let us"),
    ("y'all", "you all"),
    ("ma'am", "madam"),
    ("o'clock", "of the clock"),
    ("gonna", "going to"),
    ("wanna", "want to"),
    ("gotta", "got to"),
    ("gimme", "give me"),
    ("lemme", "let me"),
)

# Endings rewritten after the irregular words, in this order.
CONTRACTION_ENDINGS = (
    ("n't", "not"),
    ("'re", "are"),
    ("'ve", "have"),
    ("'ll", "will"),
    ("'d", "would"),
    ("'m", "am"),
)

# Words after which 's stands for "is" (elsewhere it is a possessive).
IS_HOSTS = ("it", "that", "he", "she", "what", "where", "who", "there", "here", "how", "when", "why")

# Words the Treebank tokeniser cuts in two.
TREEBANK_SPLITS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}

# Endings that inflection adds and what they replace, by part of speech, in this order.
DETACHED_ENDINGS = {
    "noun": (("s", ""), ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")),
    "verb": (("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")),
    "adjective": (("er", ""), ("est", ""), ("er", "e"), ("est", "e")),
}

# Irregular forms and their lemmas.
IRREGULAR_LEMMAS = {
    "noun": {
        "children": "child", "feet": "foot", "geese": "goose", "halves": "half", "knives": "knife", "leaves": "leaf",
        "lives": "life", "loaves": "loaf", "men": "man", "mice": "mouse", "oxen": "ox", "shelves": "shelf",
        "teeth": "tooth", "thieves": "thief", "wives": "wife", "wolves": "wolf", "women": "woman",
    },
    "verb": {
        "am": "be", "are": "be", "been": "be", "began": "begin", "came": "come", "did": "do", "does": "do", "done": "do",
        "fell": "fall", "felt": "feel", "found": "find", "gave": "give", "gone": "go", "got": "get", "had": "have",
        "has": "have", "is": "be", "kept": "keep", "knew": "know", "left": "leave", "lost": "lose", "made": "make",
        "met": "meet", "ran": "run", "said": "say", "saw": "see", "seen": "see", "shown": "show", "stood": "stand",
        "taken": "take", "thought": "think", "told": "tell", "took": "take", "was": "be", "went": "go", "were": "be",
    },
    "adjective": {"best": "good", "better": "good", "further": "far", "less": "little", "worse": "bad", "worst": "bad"},
}
