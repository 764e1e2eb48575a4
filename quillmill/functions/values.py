"""Word lists, letter tables and patterns that results depend on. Kept as they are, in their own order."""

#: Capitalised words that are no names by themselves.
CAPITAL_STOP_WORDS = (
    "The A An In On At After This However Despite Since Other Their His Her Its Born Using Starting Rescue Authorities "
    "Police Meanwhile According During While Two Three Four Five Six Seven Eight Nine Ten They These Those There When "
    "Where Which What Why How First Second Third Last New Old Published Reported State Minister Prime Chief President "
    "Government Official Officials Department Ministry Court Judge Justice Board Commission Agency Company Corp Inc Ltd "
    "Group Bank Hospital Gaya Kiya Huye Karta Haye Raha Rahi Rahe Hain Hoon"
).split()

#: News terms that keep their wording.
NEWS_TERMS = (
    "police team, police officers, police officer, police force, police station, residential building, third floor, "
    "rescue effort, rescue operation, cause of fire, under investigation, court order, high court, supreme court, "
    "judicial custody, police custody, interim bail, anticipatory bail, home ministry, defense ministry, finance ministry, "
    "health ministry, education ministry, railway ministry, government department, government scheme, government official, "
    "cabinet meeting, budget session, parliament session, election rally, election campaign, smart city project, "
    "metro project, power grid, charging station, share market, stock market, interest rate, digital payment, mutual fund, "
    "world cup match, ipl match, box office collection, emergency ward, medical college, investigation, inquiry, statement, "
    "protest, meeting, project, hospital, airport, flight, highway, expressway, bridge, tunnel, railway, traffic, budget, "
    "fund, loan, tax, subsidy, market, company, startup, inflation, gdp, app, website, portal, server, data, video, photo, "
    "post, tweet, viral, smartphone, 5g, virus, vaccine, dose, surgery, patient, doctor, nurse, match, tournament, trophy, "
    "stadium, player, captain, score, victims, effort, crisis, threat, mishap, accident, tragedy, casualty, major, digital, "
    "electronic, automatic, financial, strategic, medical"
).split(", ")

#: Stop-words of the target language, for the vocabulary miner.
TARGET_STOP_WORDS = "के की का को में से पर और है हैं था थी थे कि यह वह जो एक ने भी तो हो कर लिए किया गया गई गए इस उस साथ या तक बाद पहले दौरान लगभग".split()

#: Words known to be loans, with their Latin spelling.
LOAN_SEED = {
    "पुलिस": "police", "कोर्ट": "court", "पार्टी": "party", "प्रोजेक्ट": "project", "वीज़ा": "visa", "वीजा": "visa", "बजट": "budget",
    "रिपोर्ट": "report", "पैनल": "panel", "फ्लाईओवर": "flyover", "सुरंग": "tunnel", "पिस्तौल": "pistol", "कारतूस": "cartridge", "स्कूल": "school",
    "कॉलेज": "college", "बैंक": "bank", "मीटिंग": "meeting", "प्रोटेस्ट": "protest", "रैली": "rally", "फंड": "fund",
}

#: Code points that hint at a loan: candra o, ja, nukta, pha, nnna.
LOAN_HINTS = r"[\x{0911}\x{091C}\x{093C}\x{092B}\x{0929}]"

#: Latin letters of single Devanagari consonants.
ROMAN = {
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "च": "ch", "छ": "chh", "ज": "j", "झ": "jh", "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n",
    "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n", "प": "p", "फ": "f", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ल": "l", "व": "v",
    "श": "sh", "ष": "sh", "स": "s", "ह": "h",
}

DEVANAGARI = r"\x{0900}-\x{097F}"
#: White space of Unicode, inside a character class.
WS = r"\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The same as characters.
WS_CHARS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word character, and a word boundary written out, as \b differs between engines.
WORD = r"[\p{L}\p{N}_]"
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
NUMBER = r"\p{Nd}+(?:[.,]\p{Nd}+)?"
NAME = r"[A-Z][a-zA-Z\-]+"
TIME = r"(?:1[0-2]|0?[1-9])[.:][0-5][0-9][" + WS + r"]*(?:am|pm|AM|PM)?"
MONEY = r"(?:\$|₹|[Rr][Ss]\.?[" + WS + r"]*|[Ee][Uu][Rr][" + WS + r"]*)\p{Nd}+(?:\.\p{Nd}+)?[" + WS + r"]*(?i:million|billion|trillion|lakh|crore)?"
NOUNS = r"[A-Z][a-zA-Z.]+(?:[" + WS + r"]+[A-Z][a-zA-Z.]+)+"

MAX_ATTEMPTS, ERROR_CHARS, TITLE_CHARS, SHARDS, BATCH, TEST_BATCH, SAMPLE, TOP = 3, 500, 80, 20, 10, 5, 300, 250
