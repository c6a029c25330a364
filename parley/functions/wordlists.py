"""Word lists and constants that the scores depend on.

All of them are defaults; every operator that uses one takes it as an argument.
"""

# English function words removed before counting terms.
STOP_WORDS = """
a about above after again against all am an and any are as at be because been before being below
between both but by can cannot could did do does doing down during each few for from further had
has have having he her here hers herself him himself his how i if in into is it its itself just me
more most my myself no nor not now of off on once only or other our ours ourselves out over own same
she should so some such than that the their theirs them themselves then there these they this those
through to too under until up very was we were what when where which while who whom why will with
would you your yours yourself yourselves
""".split()

# Token valences (mean human rating, -4 to +4), Hutto & Gilbert 2014.
VALENCE = {
    "amazing": 2.8, "angry": -2.3, "annoying": -1.7, "awesome": 3.1, "awful": -2.0, "bad": -2.5,
    "beautiful": 2.9, "best": 3.2, "better": 1.9, "boring": -1.3, "brilliant": 2.8, "broken": -2.1,
    "clown": -0.9, "crash": -1.7, "crisis": -3.1, "disappointed": -2.1, "disaster": -3.1,
    "disgusting": -2.4, "dislike": -1.6, "easy": 1.9, "enjoy": 2.2, "error": -1.7, "excellent": 2.7,
    "excited": 1.4, "fail": -2.5, "fantastic": 2.6, "fear": -2.2, "fraud": -2.8, "friendly": 2.2,
    "frustrated": -2.4, "frustrating": -1.9, "fun": 2.3, "funny": 1.9, "glad": 2.0, "good": 1.9,
    "great": 3.1, "growth": 1.6, "happy": 2.7, "hate": -2.7, "help": 1.7, "helpful": 1.8,
    "horrible": -2.5, "idiot": -2.3, "impressed": 2.1, "improve": 1.9, "incompetent": -2.3,
    "innovative": 1.9, "issue": -0.6, "joke": 1.2, "like": 1.5, "lol": 1.8, "lose": -1.7,
    "loser": -2.4, "loss": -1.3, "love": 3.2, "loving": 2.9, "mistake": -1.4, "moron": -2.2,
    "nice": 1.8, "pathetic": -2.7, "perfect": 2.7, "pleased": 1.9, "poor": -2.1, "problem": -1.7,
    "problems": -1.7, "profit": 1.9, "proud": 2.1, "recommend": 1.5, "risk": -1.1, "sad": -2.1,
    "scam": -2.7, "scum": -2.4, "secure": 1.4, "smart": 1.7, "smooth": 0.9, "strong": 2.3,
    "struggling": -1.8, "stupid": -2.4, "sucks": -1.5, "superb": 3.1, "support": 1.7, "terrible": -2.1,
    "thank": 1.5, "thanks": 1.9, "trash": -1.6, "trouble": -1.7, "trust": 2.3, "ugly": -2.3,
    "unhappy": -1.8, "useful": 1.9, "useless": -1.8, "warm": 0.9, "weak": -1.9, "win": 2.8,
    "wonderful": 2.7, "worried": -1.2, "worse": -2.1, "worst": -3.1, "worthless": -1.9, "wow": 2.8,
    "wrong": -2.1, ":)": 2.0, ":(": -1.9, ":d": 2.3, ";)": 0.9,
}

# Degree words that strengthen a following valence.
INTENSIFIERS = """
absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely
especially exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin
fully greatly hella highly hugely incredibly intensely majorly more most particularly purely quite
really remarkably so substantially thoroughly totally tremendously uber unbelievably unusually
utterly very
""".split()

# Degree words that weaken a following valence.
DAMPENERS = """
almost barely hardly kinda kindof kind-of less little marginally occasionally partly scarcely
slightly somewhat sorta sortof sort-of
""".split()

# Negations; any word containing n't counts too.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt
neednt neither never none nope nor not nothing nowhere oughtnt rarely seldom shant shouldnt uhuh
wasnt werent without wont wouldnt despite
""".split()

# Constants of the sentiment rules.
DEGREE_STEP = 0.293
CAPITALS_STEP = 0.733
NEGATION_FACTOR = -0.74
LOOK_BACK_DAMPING = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_CEILING = 0.18, 0.96
NORMALISER = 15.0
POSITIVE_FROM, NEGATIVE_TO = 0.05, -0.05
