"""Small fixed lookup tables.

Their sizes are fixed (170 towns, 12 family sizes, 120 rates), so joins against
them are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# --- fixed values: towns by payment region (e, nc, nw, sc, sw) ---------------------
# Deviation: the source list splits "East Haddam" into "East" and "Haddam", which
# duplicates Haddam and leaves East Haddam without a region; corrected here.
TOWNS_BY_REGION = {
    "e": ["Ashford", "Bozrah", "Brooklyn", "Canterbury", "Chaplin", "Colchester", "Columbia", "Coventry",
          "East Lyme", "Eastford", "Franklin", "Griswold", "Groton", "Hampton", "Killingly", "Lebanon",
          "Ledyard", "Lisbon", "Mansfield", "Montville", "New London", "North Stonington", "Norwich",
          "Plainfield", "Pomfret", "Preston", "Putnam", "Salem", "Scotland", "Sprague", "Sterling",
          "Stonington", "Thompson", "Union", "Voluntown", "Waterford", "Willington", "Windham", "Woodstock"],
    "nc": ["Andover", "Avon", "Berlin", "Bloomfield", "Bolton", "Bristol", "Burlington", "Canton",
           "East Granby", "East Hartford", "East Windsor", "Ellington", "Enfield", "Farmington", "Glastonbury",
           "Granby", "Hartford", "Hebron", "Manchester", "Marlborough", "New Britain", "Newington",
           "Plainville", "Plymouth", "Rocky Hill", "Simsbury", "Somers", "Southington", "South Windsor",
           "Stafford", "Suffield", "Tolland", "Vernon", "West Hartford", "Wethersfield", "Windsor",
           "Windsor Locks"],
    "nw": ["Barkhamsted", "Beacon Falls", "Bethel", "Bethlehem", "Bridgewater", "Brookfield", "Canaan",
           "Cheshire", "Colebrook", "Cornwall", "Danbury", "Goshen", "Hartland", "Harwinton", "Kent",
           "Litchfield", "Middlebury", "Morris", "Naugatuck", "New Fairfield", "New Hartford", "New Milford",
           "Newtown", "Norfolk", "North Canaan", "Oxford", "Prospect", "Redding", "Ridgefield", "Roxbury",
           "Salisbury", "Sandy Hook", "Sharon", "Sherman", "Southbury", "Thomaston", "Torrington", "Warren",
           "Washington", "Waterbury", "Watertown", "Winchester", "Wolcott", "Woodbury"],
    "sc": ["Ansonia", "Bethany", "Branford", "Chester", "Clinton", "Cromwell", "Deep River", "Derby", "Durham",
           "East Haddam", "East Hampton", "East Haven", "Essex", "Guilford", "Haddam", "Hamden",
           "Killingworth", "Lyme", "Madison", "Meriden", "Middletown", "Middlefield", "Milford", "New Haven",
           "North Branford", "North Haven", "Old Lyme", "Old Saybrook", "Orange", "Portland", "Seymour",
           "Shelton", "Wallingford", "West Haven", "Westbrook", "Woodbridge"],
    "sw": ["Bridgeport", "Darien", "Easton", "Fairfield", "Greenwich", "Monroe", "New Canaan", "Norwalk",
           "Stamford", "Stratford", "Trumbull", "Weston", "Westport", "Wilton"],
}

# --- fixed values: income limits by family size (x75SMI, x200FPL) -----------------
INCOME_LIMITS = [
    (1, 43895, 24280), (2, 57400, 32920), (3, 70906, 41560), (4, 84413, 50200),
    (5, 97919, 58840), (6, 111452, 67480), (7, 113957, 76120), (8, 116489, 84760),
    (9, 119022, 93400), (10, 121554, 102040), (11, 124086, 110680), (12, 126619, 119320),
]

# --- fixed values: weekly reimbursement rates ------------------------------------
RATES_CSV = """\
Accredited,TitleI,Region,AgeGroup,Time,Rate
0,0,East,Infant/Toddler,FT,148.73
0,0,East,Infant/Toddler,PT,52.1
0,0,East,Preschool,FT,126.59
0,0,East,Preschool,PT,44.2
0,0,East,School-age,FT,99.05
0,0,East,School-age,PT,47.95
0,0,NorthCentral,Infant/Toddler,FT,148.73
0,0,NorthCentral,Infant/Toddler,PT,52.1
0,0,NorthCentral,Preschool,FT,126.59
0,0,NorthCentral,Preschool,PT,44.2
0,0,NorthCentral,School-age,FT,99.75
0,0,NorthCentral,School-age,PT,48.48
0,0,NorthWest,Infant/Toddler,FT,148.73
0,0,NorthWest,Infant/Toddler,PT,52.1
0,0,NorthWest,Preschool,FT,126.59
0,0,NorthWest,Preschool,PT,44.2
0,0,NorthWest,School-age,FT,102.03
0,0,NorthWest,School-age,PT,49.44
0,0,SouthCentral,Infant/Toddler,FT,153.16
0,0,SouthCentral,Infant/Toddler,PT,53.5
0,0,SouthCentral,Preschool,FT,126.59
0,0,SouthCentral,Preschool,PT,44.2
0,0,SouthCentral,School-age,FT,99.05
0,0,SouthCentral,School-age,PT,47.95
0,0,SouthWest,Infant/Toddler,FT,179.43
0,0,SouthWest,Infant/Toddler,PT,62.7
0,0,SouthWest,Preschool,FT,126.59
0,0,SouthWest,Preschool,PT,44.2
0,0,SouthWest,School-age,FT,105.7
0,0,SouthWest,School-age,PT,51.28
0,1,East,Infant/Toddler,FT,167.38
0,1,East,Infant/Toddler,PT,58.5
0,1,East,Preschool,FT,126.59
0,1,East,Preschool,PT,44.2
0,1,East,School-age,FT,110.34
0,1,East,School-age,PT,53.46
0,1,NorthCentral,Infant/Toddler,FT,167.38
0,1,NorthCentral,Infant/Toddler,PT,58.5
0,1,NorthCentral,Preschool,FT,126.59
0,1,NorthCentral,Preschool,PT,44.2
0,1,NorthCentral,School-age,FT,111.3
0,1,NorthCentral,School-age,PT,53.99
0,1,NorthWest,Infant/Toddler,FT,167.38
0,1,NorthWest,Infant/Toddler,PT,58.5
0,1,NorthWest,Preschool,FT,126.59
0,1,NorthWest,Preschool,PT,44.2
0,1,NorthWest,School-age,FT,113.75
0,1,NorthWest,School-age,PT,55.13
0,1,SouthCentral,Infant/Toddler,FT,172.32
0,1,SouthCentral,Infant/Toddler,PT,60.3
0,1,SouthCentral,Preschool,FT,126.59
0,1,SouthCentral,Preschool,PT,44.2
0,1,SouthCentral,School-age,FT,110.34
0,1,SouthCentral,School-age,PT,53.46
0,1,SouthWest,Infant/Toddler,FT,201.67
0,1,SouthWest,Infant/Toddler,PT,70.5
0,1,SouthWest,Preschool,FT,126.59
0,1,SouthWest,Preschool,PT,44.2
0,1,SouthWest,School-age,FT,118.13
0,1,SouthWest,School-age,PT,57.23
1,0,East,Infant/Toddler,FT,169.95
1,0,East,Infant/Toddler,PT,59.5
1,0,East,Preschool,FT,165.32
1,0,East,Preschool,PT,57.85
1,0,East,School-age,FT,113.2
1,0,East,School-age,PT,54.8
1,0,NorthCentral,Infant/Toddler,FT,169.95
1,0,NorthCentral,Infant/Toddler,PT,59.5
1,0,NorthCentral,Preschool,FT,165.32
1,0,NorthCentral,Preschool,PT,57.85
1,0,NorthCentral,School-age,FT,114
1,0,NorthCentral,School-age,PT,55.4
1,0,NorthWest,Infant/Toddler,FT,169.95
1,0,NorthWest,Infant/Toddler,PT,59.5
1,0,NorthWest,Preschool,FT,165.32
1,0,NorthWest,Preschool,PT,57.85
1,0,NorthWest,School-age,FT,116.6
1,0,NorthWest,School-age,PT,56.5
1,0,SouthCentral,Infant/Toddler,FT,175
1,0,SouthCentral,Infant/Toddler,PT,61.1
1,0,SouthCentral,Preschool,FT,165.32
1,0,SouthCentral,Preschool,PT,57.85
1,0,SouthCentral,School-age,FT,113.2
1,0,SouthCentral,School-age,PT,54.8
1,0,SouthWest,Infant/Toddler,FT,205.07
1,0,SouthWest,Infant/Toddler,PT,71.8
1,0,SouthWest,Preschool,FT,165.32
1,0,SouthWest,Preschool,PT,57.85
1,0,SouthWest,School-age,FT,120.8
1,0,SouthWest,School-age,PT,58.6
1,1,East,Infant/Toddler,FT,191.27
1,1,East,Infant/Toddler,PT,66.8
1,1,East,Preschool,FT,165.32
1,1,East,Preschool,PT,57.85
1,1,East,School-age,FT,126.1
1,1,East,School-age,PT,61.1
1,1,NorthCentral,Infant/Toddler,FT,191.27
1,1,NorthCentral,Infant/Toddler,PT,66.8
1,1,NorthCentral,Preschool,FT,165.32
1,1,NorthCentral,Preschool,PT,57.85
1,1,NorthCentral,School-age,FT,127.2
1,1,NorthCentral,School-age,PT,61.7
1,1,NorthWest,Infant/Toddler,FT,191.27
1,1,NorthWest,Infant/Toddler,PT,66.8
1,1,NorthWest,Preschool,FT,165.32
1,1,NorthWest,Preschool,PT,57.85
1,1,NorthWest,School-age,FT,130
1,1,NorthWest,School-age,PT,63
1,1,SouthCentral,Infant/Toddler,FT,196.94
1,1,SouthCentral,Infant/Toddler,PT,68.9
1,1,SouthCentral,Preschool,FT,165.32
1,1,SouthCentral,Preschool,PT,57.85
1,1,SouthCentral,School-age,FT,126.1
1,1,SouthCentral,School-age,PT,61.1
1,1,SouthWest,Infant/Toddler,FT,230.51
1,1,SouthWest,Infant/Toddler,PT,80.5
1,1,SouthWest,Preschool,FT,165.32
1,1,SouthWest,Preschool,PT,57.85
1,1,SouthWest,School-age,FT,135
1,1,SouthWest,School-age,PT,65.4
"""
# ----------------------------------------------------------------------------------

RATES_SCHEMA = T.StructType([
    T.StructField("Accredited", T.IntegerType()), T.StructField("TitleI", T.IntegerType()),
    T.StructField("Region", T.StringType()), T.StructField("AgeGroup", T.StringType()),
    T.StructField("Time", T.StringType()), T.StructField("Rate", T.DoubleType()),
])


def towns(spark: SparkSession) -> DataFrame:
    """``town, region`` (170 rows, unique town)."""
    rows = [(t, r) for r, ts in TOWNS_BY_REGION.items() for t in ts]
    return spark.createDataFrame(rows, "town string, region string")


def income_limits(spark: SparkSession) -> DataFrame:
    """``NumberOfPeople, x75SMI, x200FPL`` for family sizes 1-12."""
    return spark.createDataFrame(INCOME_LIMITS, "NumberOfPeople int, x75SMI int, x200FPL int")


def rates(spark: SparkSession) -> DataFrame:
    """The weekly rate grid (2 x 2 x 5 x 3 x 2 = 120 rows)."""
    lines = RATES_CSV.strip().splitlines()[1:]
    rows = []
    for line in lines:
        a, t, reg, age, tm, rate = line.split(",")
        rows.append((int(a), int(t), reg, age, tm, float(rate)))
    return spark.createDataFrame(rows, RATES_SCHEMA)


def family_sizes() -> list[int]:
    """Domain of family sizes covered by the income limits (A8 zero fill)."""
    return [n for n, _, _ in INCOME_LIMITS]


def region_code_map():
    """E5 as a ``create_map`` expression."""
    from ..functions.recode import REGION_CODES
    return F.create_map(*[F.lit(x) for kv in REGION_CODES.items() for x in kv])
