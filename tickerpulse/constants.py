"""Fixed values the results depend on.

FIXED VALUES: these must equal the behaviour being reproduced, so they are
stated plainly and in their natural order.
"""

# FIXED VALUES: the 102-symbol universe, in listing order.
TICKERS = (
    "AAPL", "MSFT", "AMZN", "TSLA", "GOOG", "GOOGL", "META", "NVDA", "PEP", "COST",
    "AVGO", "CSCO", "TMUS", "ADBE", "TXN", "CMCSA", "AMGN", "QCOM", "NFLX", "HON",
    "INTU", "INTC", "SBUX", "PYPL", "ADP", "AMD", "GILD", "MDLZ", "REGN", "ISRG",
    "VRTX", "ADI", "BKNG", "AMAT", "FISV", "CSX", "MU", "ATVI", "KDP", "CHTR",
    "MAR", "MRNA", "PANW", "ORLY", "ABNB", "MNST", "LRCX", "KHC", "SNPS", "AEP",
    "ADSK", "CDNS", "MELI", "CTAS", "FTNT", "PAYX", "KLAC", "BIIB", "DXCM", "NXPI",
    "EXC", "ASML", "LULU", "EA", "XEL", "MCHP", "CRWD", "MRVL", "AZN", "ILMN",
    "PCAR", "DLTR", "CTSH", "WDAY", "ROST", "ODFL", "WBA", "CEG", "IDXX", "TEAM",
    "VRSK", "FAST", "CPRT", "PDD", "SGEN", "SIRI", "DDOG", "LCID", "ZS", "JD",
    "EBAY", "VRSN", "ZM", "ANSS", "BIDU", "ALGN", "SWKS", "MTCH", "SPLK", "NTES",
    "DOCU", "OKTA",
)

# FIXED VALUES: prefixes that mark a symbol in text ($, # and full-width #).
SYMBOL_PREFIXES = "$#＃"

# FIXED VALUES: separator used when a post's text is joined with its context.
CONTEXT_SEPARATOR = "     "

# FIXED VALUES: the three spam rules, as (symbol, any of these tags, text prefix).
# Rule A: EBAY with any of BOUTIQUE, SEARCHNCOLLECT, ALIEXPRESS.
# Rule B: EBAY with text starting "Check out" (case-sensitive).
# Rule C: MU with tag EPEX.
SPAM_RULES = (
    ("EBAY", ("BOUTIQUE", "SEARCHNCOLLECT", "ALIEXPRESS"), None),
    ("EBAY", None, "Check out"),
    ("MU", ("EPEX",), None),
)

# FIXED VALUES: co-tag dropped from the hourly co-tag counts.
STOP_TAG = "STOCKS"

# FIXED VALUES: ISO pattern of the post creation time.
CREATED_AT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSX"

# FIXED VALUES: label joiner for the hourly leader (symbol, co-tag).
LEADER_JOINER = "•"

# FIXED VALUES: rule sizes (symbols per OR rule) used by the two collectors.
RULE_SIZE_CASHTAG = 6
RULE_SIZE_HASHTAG = 17

# FIXED VALUES: rolled ingest file size in bytes.
ROLL_BYTES = 50_000_000

# FIXED VALUES: JDBC write batch size.
JDBC_BATCH_SIZE = 100000
