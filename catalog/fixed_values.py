"""Fixed values of the published methods, spelled out again for the SQL.

The queries' modules have their own; a value changed in one place only shows up as a
difference between a query and its SQL.
"""

# Normal quantile (Wichura, AS 241), numerators and denominators, lowest power first.
CENTRE_NUM = (
    3.3871328727963665, 133.14166789178438, 1971.5909503065513, 13731.69376550946,
    45921.95393154987, 67265.7709270087, 33430.57558358813, 2509.0809287301227,
)
CENTRE_DEN = (
    1.0, 42.31333070160091, 687.1870074920579, 5394.196021424751,
    21213.794301586597, 39307.89580009271, 28729.085735721943, 5226.495278852854,
)
MIDDLE_NUM = (
    1.4234371107496835, 4.630337846156546, 5.769497221460691, 3.6478483247632045,
    1.2704582524523684, 0.2417807251774506, 0.022723844989269184, 0.0007745450142783414,
)
MIDDLE_DEN = (
    1.0, 2.053191626637759, 1.6763848301838038, 0.6897673349851,
    0.14810397642748008, 0.015198666563616457, 0.0005475938084995345, 1.0507500716444169e-09,
)
TAIL_NUM = (
    6.657904643501103, 5.463784911164114, 1.7848265399172913, 0.29656057182850487,
    0.026532189526576124, 0.0012426609473880784, 2.7115555687434876e-05, 2.0103343992922881e-07,
)
TAIL_DEN = (
    1.0, 0.599832206555888, 0.1369298809227358, 0.014875361290850615,
    0.0007868691311456133, 1.8463183175100548e-05, 1.421511758316446e-07, 2.0442631033899397e-15,
)

# Shapiro-Wilk (Royston 1995).
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_MEAN = (0.544, -0.39978, 0.025054, -0.0006714)
SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
SMALL_BOUND = (-2.273, 0.459)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)

# Lexicon scoring (Hutto and Gilbert 2014).
BOOST = 0.293
CAPS_BOOST = 0.733
NEGATION_FACTOR = -0.74
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
EXCLAMATION_STEP = 0.292
EXCLAMATION_MAX = 4
QUESTION_STEP = 0.18
QUESTION_STEPS = 3
QUESTION_MAX = 0.96
NORMALIZER = 15.0
DAMPENER_PAIRS = ('just enough', 'kind of', 'sort of')
STRIPPED_RUNS = ('.', '!', '?', ',', ';', ':', '-', "'", '"', '!!', '!!!', '??', '???', '?!?', '!?!', '?!?!', '!?!?')
