"""Word lists and patterns as data, with one reading for Spark (Java regexes) and one for SQL (RE2).

A pattern block has a pattern a line. Every pattern is bounded by word boundaries and ignores case,
unless it begins with '=' (case counts) or '~' (taken as it stands, ignoring case). Blocks are parameters
of the operators, so that another vocabulary can take their place.
"""

from __future__ import annotations

import itertools
import warnings

with warnings.catch_warnings():
    warnings.simplefilter("ignore")
    from re import _parser

#: An ASCII word boundary: Java's own takes in accented letters.
EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"


def lines(block: str) -> list[str]:
    return [x.strip() for x in block.strip().splitlines() if x.strip()]


def sql_pattern(line: str) -> str:
    if line.startswith("~"):
        return "(?i)" + line[1:]
    exact = line.startswith("=")
    return ("" if exact else "(?i)") + r"\b(?:" + line[exact:] + r")\b"


def java_pattern(line: str) -> str:
    """A bounded pattern begins and ends with word characters, so that a look to one side will do."""
    if line.startswith("~"):
        return sql_pattern(line).replace(r"\b", EDGE)
    exact = line.startswith("=")
    return ("" if exact else "(?i)") + r"(?<![0-9A-Za-z_])(?:" + line[exact:].replace(r"\b", EDGE) + r")(?![0-9A-Za-z_])"


def any_of(block: list[str]) -> list[str]:
    """As few Java regexes as will do; a text that matches one of them matches a pattern of the block. The side
    condition comes before the alternatives, so that these are tried at the beginnings of words only."""
    exact, loose = [x[1:] for x in block if x[0] == "="], [x for x in block if x[0] not in "=~"]
    raw = [java_pattern(x)[4:] for x in block if x[0] == "~"]
    out = [java_pattern("=" + "|".join(f"(?:{x})" for x in exact))] if exact else []
    out += [java_pattern("|".join(f"(?:{x})" for x in loose))] if loose else []
    return out + (["(?i)" + "|".join(f"(?:{x})" for x in raw)] if raw else [])


HEAD = 3


def _heads(items: list, most: int = 400) -> tuple[set[str], bool] | None:
    """The possible first HEAD characters of what a parsed pattern matches, up to the end of its first word, digits as 0
    and letters lowered; and whether all are complete (the word is over or HEAD is reached). None: too many."""
    open_ = {""}  # beginnings that what follows can still lengthen
    done: set[str] = set()
    for op, arg in items:
        name = str(op)
        if name == "AT" or (name.startswith("ASSERT")):
            continue
        new: set[str] = set()
        if name == "LITERAL":
            new = {_fold(chr(arg))}
        elif name == "IN":
            for k, v in arg:
                if str(k) == "LITERAL":
                    new.add(_fold(chr(v)))
                elif str(k) == "RANGE":
                    new |= {_fold(chr(c)) for c in range(v[0], v[1] + 1)}
                elif str(k) == "CATEGORY" and str(v) == "CATEGORY_DIGIT":
                    new.add("0")
                elif str(k) == "CATEGORY" and str(v) == "CATEGORY_SPACE":
                    new.add(" ")
                else:
                    return None
        elif name in ("SUBPATTERN", "BRANCH", "MAX_REPEAT", "MIN_REPEAT"):
            if name == "SUBPATTERN":
                parts = [list(arg[3])]
            elif name == "BRANCH":
                parts = [list(x) for x in arg[1]]
            else:
                lo, hi, inner = arg
                counts = range(int(lo), min(int(hi), HEAD) + 1) if int(lo) <= HEAD else [HEAD]
                parts = [list(inner) * k for k in counts]
            for x in parts:
                got = _heads(x, most)
                if got is None:
                    return None
                new |= got[0]
        else:
            return None
        grown = {a + b for a, b in itertools.product(open_, new)}
        open_ = set()
        for g in grown:
            word = _word(g)
            if word != g or len(g) >= HEAD:
                done.add(word[:HEAD] if word == g else word + " ")
            else:
                open_.add(g)
        if len(open_) + len(done) > most:
            return None
        if not open_:
            break
    return done | open_, not open_


def _fold(c: str) -> str:
    c = c.lower()
    return "0" if c.isdigit() else c


def _word(g: str) -> str:
    for i, c in enumerate(g):
        if not (c.isascii() and (c.isalnum() or c == "_")):
            return g[:i]
    return g


def heads(line: str) -> list[str] | None:
    """How the word begins, in which any match of the pattern begins: its first HEAD characters (all of a shorter word),
    lowered, digits as 0. None: can't be told, or a match needn't begin with a word."""
    body = line[1:] if line[0] in "=~" else line
    if line[0] == "~":
        if not body.startswith(r"\b"):
            return None
        body = body[2:]
    got = _heads(list(_parser.parse("(?:" + body + ")")))
    if got is None:
        return None
    own = {h.rstrip(" ")[:HEAD] for h in got[0]}
    return sorted(own) if all(own) else None


def needles(line: str) -> list[str] | None:
    """Lower-case strings of which every match holds one; None: can't be told."""
    body = line[1:] if line[0] in "=~" else line

    def of(items: list) -> list[str] | None:
        found: list[list[str]] = []
        run = ""
        for op, arg in [*items, ("END", None)]:
            if str(op) == "LITERAL" and chr(arg).isascii():
                run += chr(arg).lower()
                continue
            if len(run) > 1:
                found.append([run])
            run = ""
            if str(op) == "SUBPATTERN":
                x = of(list(arg[3]))
                if x:
                    found.append(x)
            elif str(op) == "BRANCH":
                each = [of(list(x)) for x in arg[1]]
                if all(each):
                    found.append([w for x in each for w in x])
        return max(found, key=lambda x: min(map(len, x)), default=None)

    return of(list(_parser.parse("(?:" + body + ")")))


#: slug -> (weight, patterns), the first wins ties
CATEGORIES: dict[str, tuple[int, list[str]]] = {
    slug: (weight, lines(block))
    for slug, weight, block in [
        ("tankers", 1, r"""
            aframax
            chemical tanker
            crude (?:oil )?(?:carrier|tanker)
            lr[12]
            (?:lng|lpg) (?:carrier|tanker|vessel)
            MR tanker
            product tanker
            suezmax
            tankers?
            vlccs?"""),
        ("container", 1, r"""
            box ?ships?
            =CMA[\s-]?CGM
            container (?:fleet|line|market|terminal|trade)
            container ?ships?
            COSCO Shipping
            evergreen marine
            feeder vessels?
            =Gemini Cooperation
            =Hapag-?Lloyd
            =HMM Co
            liner shipping
            =Maersk
            mainline (?:carrier|operator|service)
            =MSC
            ocean network express
            PIL Pacific
            =(?:2M|MSC\+|Ocean|Premier|THE) Alliance
            teu
            \d{2,3},?\d{3}\s?teu
            wan hai
            yang ming
            zim (?:integrated|lines?)"""),
        ("dry-bulk", 1, r"""
            baltic dry index
            bdi
            bulk carriers?
            capesize
            coal (?:cargo|shipment)
            dry bulk
            grain (?:cargo|export|shipment)
            handymax
            handysize
            iron ore
            panamax
            supramax"""),
        ("regulations", 1, r"""
            CII|EEDI|EEXI|EU ETS|FuelEU
            EU directive
            =IMO
            (?:imo|maritime|mlc|shipping|stcw) (?:amendment|convention|protocol|treaty)
            (?:maritime|ship|shipping|vessel) regulations?
            MARPOL
            ~\bMEPC\s*\d+
            ~\bMSC\s*\d+
            port state control
            PSC inspection
            regulatory (?:framework|update)
            sanctions list|sanction(?:ed|s)
            SOLAS"""),
        ("accidents", 2, r"""
            allided|allision
            capsiz(?:e|ed|ing)
            casualt(?:ies|y)
            collision
            distress (?:call|signal)
            explosion
            fire (?:aboard|broke out|on board)
            groundings?
            mayday
            oil spill
            salvage
            ship (?:accident|incident)
            sink(?:ed|ing|s)"""),
        ("pi-insurance", 1, r"""
            club circular
            FD&D
            H&M
            hull (?:and|&) machinery
            K&R
            kidnap and ransom
            marine insurance
            P and I
            P&I
            protection and indemnity
            underwriters?
            war risk (?:cover|insurance)"""),
        ("classification", 1, r"""
            ABS class
            american bureau of shipping
            bureau veritas
            china classification society
            class notation
            class societ(?:ies|y)
            class(?:ed|ification) (?:by|with)
            classification societ(?:ies|y)
            =ClassNK
            =DNV
            =IACS
            indian register of shipping
            korean register
            lloyd's register
            polish register of shipping
            RINA (?:class|register|S\.p\.A)
            type approval"""),
        ("shipbuilding", 1, r"""
            CSSC|Daewoo|DSME|Hanwha Ocean|Hudong-Zhonghua|Hyundai Heavy|Imabari|JMU|Samsung Heavy|Tsuneishi
            delivered (?:first|its|the)
            first steel|steel cutting
            keel (?:laid|laying)
            launch ceremony
            newbuild(?:ing)?s?
            ordered (?:\d+ )?(?:boxships|carriers|ships|tankers|vessels)
            shipyards?"""),
        ("offshore", 1, r"""
            =AHTS|OSV|PSV
            =CTV|SOV|WTIV
            decommission(?:ing)?
            drilling rigs?
            =FPSO
            jack-?ups?
            offshore wind
            oil platforms?
            semi-?submersibles?
            subsea
            wind (?:farm|turbine installation)"""),
        ("ports", 1, r"""
            berths?
            cargo throughput
            container terminal
            dredging
            harbor ?master
            port authority
            =port of [A-Z][a-z]+
            stevedor(?:e|ing)
            terminals?"""),
        ("crew", 1, r"""
            abandoned crew
            cadets?
            certificate of competenc(?:e|y)
            crew change
            crew welfare
            manning agenc(?:ies|y)
            maritime labou?r
            =MLC
            repatriation
            seafarers?
            ship (?:manager|owner) wages
            shore leave"""),
    ]
}

#: A vocabulary of common function words, for prose without maritime content.
PROSE_CATEGORIES: dict[str, tuple[int, list[str]]] = {
    "english": (1, ["the", "and", "of", "that", "with"]), "german": (1, ["der", "die", "und", "mit", "nicht"]), "french": (1, ["le", "la", "des", "pour", "avec"]), "spanish": (1, ["el", "los", "que", "una", "para"]),
}

#: slug -> patterns; all that match
SEGMENTS: dict[str, list[str]] = {
    slug: lines(block)
    for slug, block in [
        ("tanker", r"""
            tankers?
            =[UV]LCCs?
            aframax|suezmax
            crude\s+(?:oil\s+)?carrier
            BCTI|BDTI|world\s*scale|WS\s*\d{2,3}
            Ardmore\s+Shipping|DHT\s+Holdings|Euronav|Frontline|Hafnia\s+Ltd?|International\s+Seaways
            ~\bTORM\s+(?:plc)?\b"""),
        ("container", r"""
            box\s*ships?|container\s*ships?
            =\d{1,2},?\d{3}\s*TEU
            \d{1,3}k\s+TEU
            containeri[sz]ed
            feeder\s+(?:service|vessel)
            liner\s+(?:service|shipping|trade)
            mainline\s+(?:carrier|service)
            container\s+(?:business|cargo|carrier|earnings|fleet|freight|industry|lines?|market|operation|operator|rates?|sector|shipping|terminals?|trade|volumes?)
            CCFI|Drewry\s+World\s+Container|FBX|HARPEX|HRCI|SCFI|WCI|XSI
            =HMM(?:\s+(?:Co|Container|Korea))?
            ~\bMediterranean\s+Shipping\s+Co
            CMA\s+CGM|COSCO\s+Shipping|Evergreen\s+(?:Line|Marine)|Hapag-Lloyd|Wan\s+Hai|Yang\s+Ming
            ONE\s+(?:Container|Line|Network)
            ZIM\s+(?:Integrated|Lines|Shipping)
            =(?:2M|Gemini|Ocean|Premier|THE)\s+(?:Alliance|Cooperation)"""),
        ("dry_bulk", r"""
            bulk\s+(?:carriers?|fleet|market|sector|shipping|trade)
            capesizes?|handysizes?|newcastlemax
            (?:handy|kamsar|pana|supra|ultra)max(?:es)?
            dry\s+bulk
            bauxite\s+cargo
            iron\s+ore
            ore\s+(?:cargoes|cargo)
            (?:bauxite|chrome|chromium|fluorspar|manganese|nickel)\s+ore
            coal\s+(?:cargo|carrier|shipment|trade)
            grain\s+(?:cargo|export|shipment|trade)
            group\s+a\s+cargo(?:es)?
            =BCI|BDI|BHSI|BPI|BSI
            Baltic\s+(?:Capesize|Dry|Handysize|Panamax|Supramax)\s+Index
            may\s+liquefy|cargo\s+liquefaction|solid\s+bulk\s+cargo(?:es)?
            2020\s+Bulkers|Berge\s+Bulk|Diana\s+Shipping|Eagle\s+Bulk|Genco\s+Shipping|Golden\s+Ocean|Himalaya\s+Shipping|Pacific\s+Basin|Safe\s+Bulkers|Star\s+Bulk"""),
        ("lng_lpg", r"""
            gas\s+carriers?
            liquefied\s+(?:natural|petroleum)\s+gas
            (?:LNG|LPG)\s+(?:bunkering|cargo|cargoes|carriers?|charter|chartering|export|fleet|force\s+majeure|imports?|industry|market|sector|ships?|spot|tankers?|terminal|trade|vessels?)
            (?:ammonia|methanol)\s+(?:bunker|carrier|fuel|ship|vessel)
            =VLGCs?|MGCs?|FSRUs?|FLNG
            (?:JKM|TTF)\s+(?:index|price|spot)
            Awilco\s+LNG|BW\s+(?:LNG|LPG)|Capital\s+Gas|Cool\s+Company|Dynagas|Excelerate\s+Energy|Flex\s+LNG|GasLog|H[öo]egh\s+LNG"""),
        ("offshore", r"""
            drilling\s+rigs?|jack-?ups?|oil\s+platform|semi-?submersibles?|subsea
            =AHTS|CTV|FPSOs?|FPUs?|OSV|PSV|SOV|WTIV
            offshore\s+(?:fleet|gas|industry|installation|market|oil|sector|service|vessels?|wind)
            wind\s+(?:farm|turbine\s+installation)
            Bourbon|Bumi\s+Armada|DOF\s+Group|McDermott\s+International|Modec|Saipem|SBM\s+Offshore|Solstad\s+Offshore|Subsea\s*7|TechnipFMC|Transocean|Yinson"""),
        ("cruise", r"""
            cruise\s+(?:bookings?|business|company|deployment|fleet|industry|lines?|operators?|sector|ships?|vessels?)
            passenger\s+(?:cruise|liner|ship|vessel)
            Carnival\s+(?:Corporation|Cruises?)|MSC\s+Cruises|Norwegian\s+Cruise\s+Line
            (?:AIDA|Celebrity|Costa|Cunard|Holland\s+America|P&O\s+Cruises|Princess)\s+Cruises?
            RCL\s+Holdings|Royal\s+Caribbean\s+(?:Cruises|Group|International)"""),
    ]
}
#: A match of the first counts only where what follows isn't the second: segment -> (pattern, what mustn't follow).
NOT_BEFORE = {"=HMM(?:\\s+(?:Co|Container|Korea))?": r"\s+(?:Drilling|Offshore)"}
SEGMENT_LABELS = {"container": "Container", "cruise": "Cruise", "dry_bulk": "Dry Bulk", "lng_lpg": "LNG / LPG", "offshore": "Offshore", "tanker": "Tankers"}
TYPE_LABELS = {"casualty_report": "Casualty", "class_notice": "Class Notice", "market_report": "Market Report", "news": "News", "pi_circular": "P&I Circular", "press_release": "Press", "psc_report": "PSC Report", "regulation": "Regulation"}
CATEGORY_SEGMENT = {"container": "container", "dry-bulk": "dry_bulk", "offshore": "offshore", "tankers": "tanker"}
SOURCE_SEGMENT = {"container": "container", "tanker": "tanker", "lng|lpg": "lng_lpg", "offshore": "offshore", "bulk|bulker": "dry_bulk", "cruise": "cruise"}

MARITIME = lines(r"""
    cargo(?:es)?
    (?:charter(?:ing)?|charterer|charterparty)
    =IACS
    =IMO
    =MARPOL
    =MOU
    =P&I
    =PSC
    =SOLAS
    =TEUs?
    bulk\s*carriers?
    class(?:ification)?\s+societ(?:ies|y)
    container(?:ised|ized|s|ship)?
    crude\s+(?:carrier|oil|tanker)
    ~\bcruise\s+(?:industry|line|ship)
    freight
    ~\b(?:LNG|LPG)\s+(?:bunker|carrier|fleet|terminal)
    ~\boffshore\s+(?:gas|installation|oil|vessel|wind)
    (?:carrier|line|operator)s?\b.{0,40}\b(?:liner|maritime|ocean|sea|shipping)
    (?:port|terminal)s?
    ship(?:broker|builder|management|owner|ping|s|yard)?
    tankers?
    vessels?""")
SPAM = lines(r"""
    throne\s+and\s+liberty
    video\s+game
    gaming\s+(?:build|guide|playstyle|tips)
    (?:build|loadout|skill|weapon)s?\s+(?:guide|meta|tier)
    (?:find|finding)\s+love
    after\s+divorce
    dating\s+(?:advice|again|tips)
    relationship\s+advice
    luxury\s+car\s+rental
    (?:exotic|VIP)\s+cars?
    (?:Audi|BMW|Ferrari|Mercedes|Rolls-?Royce)\b.{0,40}\b(?:dubai|rent|rental)
    twitter\s+(?:engagement|impact|marketing)
    tiktok\s+(?:marketing|strategy)
    social\s+media\s+(?:marketing|tips)
    brand\s+marketing\s+and\s+customer\s+engagement
    rotating\s+file\s+cabinet
    office\s+(?:chair|design|desk|furniture)
    ergonomic\s+(?:chair|desk)
    professional\s+development\s+paths?\s+for\s+marketers
    availability\s+tracker
    supply\s+chain\s+visibility\s+software""")
BOILERPLATE = ["~" + x for x in ("all rights reserved|©", "cookie policy", "emergency contact", "enable (?:cookies|javascript)", "latest updates", "(?:log|sign) in", "main menu", "outdated browser", "please subscribe", "skip to content", "toggle navigation", "upgrade to a modern", "you are using", r"^(?:home|menu)\b")]
CTA = ["download", "go to", "learn more", "read more", "register", "sign in", "sign up", "subscribe", "view all", "visit"]
HUB_TITLES = ["~" + x for x in (
    r"^articles?$", r"^events?$", r"^publications?$", r"^downloads?$", r"^page\s+\d+\s*(?:of\s+\d+)?$", r"^(?:content\s+page|index|table\s+of\s+contents?)$", r"^(?:all|latest)\s+(?:articles|news|publications|updates)$",
    r"^(?:dashboard|databases?|directory|forms?|portal)$", r"^(?:home|homepage|landing\s+page|main\s+page)$", r"^(?:browse|explore)\s+(?:our\s+)?(?:insights?|publications?|resources?|rules?|services?)\s*$",
    r"^news?\s*(?:&|and)\s*(?:insights?|publications?|resources?)\s*$", r"^rules?\s*(?:&|and)\s*(?:guides?|regulations?|resources?)\s*$",
)]
CTA_TITLES = ["~" + x for x in (
    r"^(?:click|tap)\s+here\s*$", r"^(?:see|view)\s+(?:all|details|more)\s*$", r"^(?:learn|read)\s+more\s*$", r"^(?:all|more|see)\s+(?:articles|news|publications|updates)\s*$", r"^press\s+release\s*$", r"^download\s+(?:brochure|file|pdf|v?card)\s*$",
    r"^(?:enroll|membership|register\s+today)\b", r"^(?:buy|order|plans?|pricing|purchase)\b", r"\b(?:client\s+portal|my\s*\w+\s+portal|portal)\s*$", r"^flag\s+(?:&|and)\s+port\s+state\s+info$", r"^engineering\s+(?:applications?|software)$",
    r"^explore\s+(?:global|our|the)\s+\w+$", r"^webinar\s+test$", r"^(?:about\s+us|careers?\s+at|contact\s+us|join\s+us|our\s+team)$", r"^(?:cookie\s+(?:notice|policy)|disclaimer|legal\s+notice|privacy\s+(?:notice|policy)|terms\s+(?:and|of))\b",
    r"^(?:log\s*(?:in|out)|sign\s*(?:in|up))\s*(?:for|to)?\b", r"^subscribe\s+(?:to\s+)?(?:our\s+)?(?:alerts?|mailing\s+lists?|newsletter|updates?)\b", r"^stay\s+(?:alert|informed|up\s+to\s+date)\b",
)] + [r"~^[a-z]+[™®]"]
JUNK_URLS = ["~/(?:" + x + ")" for x in ("products?-and-services?|products?/|services?/", "client-?portal|dashboard/?$|my-?freedom|portal/?$", "enroll|login|register|sign-?in|sign-?up", "engineering-(?:applications|software)|software", "buy|cart|checkout|order|plans|pricing|purchase", "my-account|profile|settings")]
LOCKED = ["~" + x for x in (r"lost your password\?.{0,60}(?:don'?t have an account|register)", "select a .{0,25}subscription package", "subscription package to unlock", "this content is locked", "unlock the content")]
JUNK_PHRASES = ["~" + x for x in (r"(?:log\s*in|sign\s*in)\b.{0,30}(?:newsletter|register|subscribe)", r"(?:sign\s*up|subscribe).{0,40}(?:alerts?|newsletter|updates)")]
MARKET = lines(r"""
    baltic\s+(?:capesize|clean|dirty|dry|handysize|panamax|supramax)\s+index
    =BCI|BDI|BHSI|BPI|BSI
    (?:charter|container|spot)\s+rates
    freight\s+rates?
    market\s+(?:forecast|outlook|report|review|update|wrap)
    (?:q[1-4]|quarterly)\s+(?:earnings|outlook|results)
    (?:Aframax|LR[12]|MR|Suezmax|VLCC)\s+(?:earnings|rates|spot)
    ship\s+demolition\s+(?:market|prices)
    vessel\s+earnings
    weekly\s+(?:forecast|outlook|report)""")
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
TRACKING = ["utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term", "fbclid", "gclid", "redirect", "_"]
LANDING = sorted("all archive archives articles author authors categories category feed home index magazine magazines news page pages posts rss section sections tag tags topic topics video videos".split())

#: What a paywall says: a first part joined to each of its second parts.
PAYWALL = sorted(
    f"{a} {b}".strip()
    for a, bs in {
        "become a": ["member to", "subscriber to"], "begin": ["a free trial", "free trial", "your free trial"], "start": ["free trial", "your free trial"], "free trial to": ["continue", "read", "view"],
        "create an account to": ["continue", "read", "view"], "join to": ["continue", "read"], "log in to": ["continue", "read", "see", "view", "your account to continue"], "please log in to": ["continue", "read", "view"],
        "only available to": ["members", "paid subscribers", "subscribers"], "register to": ["continue", "read", "view"], "register now to read": [""], "sign in to": ["continue", "read", "view", "your account"],
        "sign up to": ["continue", "read", "view"], "subscribe to": ["continue", "read", "view"], "subscribe now": ["", "to continue", "to read", "to view"], "subscription": ["needed", "required"],
        "this article is for": ["members", "paid subscribers", "subscribers"], "this content is locked": [""], "unlock": ["the rest of this article", "this article"],
        "members only": [""], "subscribers only": [""], "paid subscribers only": [""], "premium subscribers only": [""],
    }.items()
    for b in bs
)

#: Words that are no keywords.
STOP_WORDS = sorted(set("""
    a about above across after against all also am an and announced announces any are article articles as association at bad be been before being below between big bulletin bulletins business businesses but by
    can circular circulars club clubs companies company could details did do does doing done during even every first five for four from good had has have having he her hers high him his home how
    in industry information into is it its just last least less long low many maritime may member members might more most much must new news next nor notice notices now ocean oceans of old on one only onto or organisation our ours over
    page recent recently release releases report reported reports said says sea seas second shall she ship shipping ships short should small so some soon still that the their them then these they this those three through to today tomorrow two
    under update updates us vessel vessels was water waters we website were what when where which who whom whose why will with would yesterday yet you your yours""".split()))

#: (pattern of a URL, tag slugs), the first parts of publishers' own topic pages.
URL_RULES = [(r"(?i)skuld\.com/topics/" + x, [y]) for x, y in (
    ("cargo/", "cargo-claims"), ("environment/", "pollution-claims"), ("legal/pi-and-defence/", "fdd"), ("legal/sanctions/", "russia-sanctions"), ("people/", "crew-claims"), ("port/", "ports"), ("port/piracy/", "piracy"), ("ship/(?:bunkers|navigation|safety)/", "loss-prevention"),
)] + [(r"(?i)britanniapandi\.com/category/" + x, y) for x, y in (
    ("(?:bsafe|case-study|loss-prevention)", ["loss-prevention"]), ("crew-watch", ["crew-claims", "crew-watch"]), ("health-watch", ["crew-claims", "health-watch"]), ("risk-watch", ["loss-prevention", "risk-watch"]),
)] + [(r"(?i)westpandi\.com/.*topics=lossprevention", ["loss-prevention"]), (r"(?i)westpandi\.com/.*topics=sanctions", ["russia-sanctions"])]
#: (pattern of a title, tag slugs that it rules out)
FALSE_CONTEXTS = [
    (r"class[-\s]action", ["abs", "bureau-veritas", "ccs-class", "classnk", "dnv", "korean-register", "lloyds-register", "polish-register-of-shipping", "rina-class"]),
    (r"gas station", ["lng-bunkering"]), (r"pilot (?:episode|project|scheme)|test pilot", ["ports"]),
]
#: Tags whose names are matched with their case.
CASE_TAGS = sorted("abs ais bimco bureau-veritas ccs-class cii classnk eedi eexi emsa eu-ets fueleu-maritime ics-shipping imo lloyds-register msc one-line rina-class us-coast-guard".split())
