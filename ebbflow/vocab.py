"""Labels, code lists, weights and holidays used by the operators."""

# The 15 five-year age groups of the model (70 and over merged).
AGE_LABELS_15 = [
    "0-4", "5-9", "10-14", "15-19", "20-24", "25-29", "30-34", "35-39",
    "40-44", "45-49", "50-54", "55-59", "60-64", "65-69", "70+",
]
AGE_STARTS_15 = [0, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70]

# Ages kept in the mobility feed (0-9 is dropped, 80 joins 70).
MOBILITY_AGES_RAW = [10, 20, 30, 40, 50, 60, 70, 80]
MOBILITY_AGES = [10, 20, 30, 40, 50, 60, 70]

# Trip purposes of the movement feed.
PURPOSE_LABELS = {
    1: "commute", 2: "school", 3: "home", 4: "shopping",
    5: "tourism", 6: "hospital", 7: "other",
}

# Capital-region codes and names.
CAPITAL_SIDO_PREFIXES = ["11", "28", "41"]
CAPITAL_SIDO_NAMES = ["서울특별시", "경기도", "인천광역시"]
SIDO_BY_PREFIX = {"11": "서울", "28": "인천", "41": "경기"}

# Day types and the four contact settings with their weights.
DAYTYPES = ["weekday_school", "vacation_weekday", "weekend", "holiday"]
SETTINGS = ["home", "work", "school", "other"]
SETTING_WEIGHTS = {
    "weekday_school": {"home": 1.0, "work": 1.0, "school": 1.0, "other": 1.0},
    "vacation_weekday": {"home": 1.1, "work": 1.0, "school": 0.2, "other": 1.1},
    "weekend": {"home": 1.3, "work": 0.2, "school": 0.0, "other": 1.2},
    "holiday": {"home": 1.3, "work": 0.2, "school": 0.0, "other": 1.2},
}

# Public holidays 2018-2023 of the school calendar (yyyymmdd).
SCHOOL_HOLIDAYS = [
    20180101, 20180215, 20180216, 20180217, 20180301, 20180505, 20180507, 20180522,
    20180606, 20180813, 20180815, 20180923, 20180924, 20180925, 20180926, 20181003,
    20181009, 20181225,
    20190101, 20190204, 20190205, 20190206, 20190301, 20190505, 20190506, 20190512,
    20190606, 20190815, 20190912, 20190913, 20190914, 20191003, 20191009, 20191225,
    20200101, 20200124, 20200125, 20200126, 20200127, 20200301, 20200430, 20200505,
    20200606, 20200815, 20200817, 20200930, 20201001, 20201002, 20201003, 20201009,
    20201225,
    20210101, 20210211, 20210212, 20210213, 20210301, 20210505, 20210519, 20210606,
    20210815, 20210816, 20210920, 20210921, 20210922, 20211003, 20211004, 20211009,
    20211011, 20211225,
    20220101, 20220131, 20220201, 20220202, 20220301, 20220309, 20220505, 20220508,
    20220601, 20220606, 20220815, 20220909, 20220910, 20220911, 20220912, 20221003,
    20221009, 20221010, 20221225,
    20230101, 20230121, 20230122, 20230123, 20230124, 20230301, 20230505, 20230527,
    20230529, 20230606, 20230815, 20230928, 20230929, 20230930, 20231002, 20231003,
    20231009, 20231225,
]
# The mobility calendar has two election days more and one day less.
MOBILITY_ONLY_HOLIDAYS = [20180613, 20200415]
SCHOOL_ONLY_HOLIDAYS = [20180813]
MOBILITY_HOLIDAYS = sorted(
    [d for d in SCHOOL_HOLIDAYS if d not in SCHOOL_ONLY_HOLIDAYS] + MOBILITY_ONLY_HOLIDAYS
)
HOLIDAY_CALENDARS = {"school": SCHOOL_HOLIDAYS, "mobility": MOBILITY_HOLIDAYS}

# School terms as mmdd ranges, both ends included.
SCHOOL_TERMS = [(301, 720), (820, 1220)]

# Influenza surveillance groups, slots per row and season length.
ILI_AGE_GROUPS = ["0", "1-6", "7-12", "13-18", "19-49", "50-64", "65+"]
ILI_SLOTS = 54
SEASON_WEEKS = 52
SEASON_FIRST_ISO_WEEK = 36
SEASON_SUFFIX = "절기"

# Share of each of the 15 age groups covered by a surveillance group.
ILI_BRIDGE_WEIGHTED = {
    "0": {0: 0.2},
    "1-6": {0: 0.8, 1: 0.4},
    "7-12": {1: 0.6, 2: 0.6},
    "13-18": {2: 0.4, 3: 0.8},
    "19-49": {3: 0.2, 4: 1.0, 5: 1.0, 6: 1.0, 7: 1.0, 8: 1.0, 9: 1.0},
    "50-64": {10: 1.0, 11: 1.0, 12: 1.0},
    "65+": {13: 1.0, 14: 1.0},
}
# The older unweighted mapping (kept for comparison).
ILI_BRIDGE_UNWEIGHTED = {
    "0": [0], "1-6": [0, 1], "7-12": [1, 2], "13-18": [2, 3],
    "19-49": [4, 5, 6, 7, 8, 9], "50-64": [10, 11, 12], "65+": [13, 14],
}

# Insurance-claims labels, sexes, columns and province codes.
CLAIMS_SETTINGS = ["outpatient_inpatient", "inpatient_only"]
CLAIMS_AGE_GROUPS = ["0-5", "6-11", "12-17", "18-44", "45-64", "65+"]
CLAIMS_AGE_LABELS = {
    "1. 0-5세": "0-5", "2. 6-11세": "6-11", "3. 12-17세": "12-17",
    "4. 18-44세": "18-44", "5. 45-64세": "45-64", "6. 65세 이상": "65+",
}
CLAIMS_SEXES = {"남자": "M", "여자": "F"}
CLAIMS_COLUMNS = {
    "요양개시일자": "date", "주소(시도)": "sido_code", "성별": "sex_raw",
    "연령군": "age_group_raw", "진료에피소드 건수": "episodes",
}
CLAIMS_SIDO_NAMES = {
    11: "서울특별시", 26: "부산광역시", 27: "대구광역시", 28: "인천광역시",
    29: "광주광역시", 30: "대전광역시", 31: "울산광역시", 36: "세종특별자치시",
    41: "경기도", 43: "충청북도", 44: "충청남도", 45: "전라북도", 46: "전라남도",
    47: "경상북도", 48: "경상남도", 50: "제주특별자치도", 51: "강원특별자치도",
    52: "전북특별자치도",
}
CLAIMS_CAPITAL_CODES = [11, 28, 41]
# The old province code that a new one replaces.
SIDO_SUCCESSOR = {45: 52}

# Employment table vocabulary.
EMPLOYMENT_SEXES = ["계", "남자", "여자"]
EMPLOYMENT_TOTAL_AGE = "합계"
EMPLOYMENT_SIDO = {
    "서울특별시": "서울", "부산광역시": "부산", "대구광역시": "대구", "인천광역시": "인천",
    "광주광역시": "광주", "대전광역시": "대전", "울산광역시": "울산",
    "세종특별자치시": "세종", "경기도": "경기", "강원도": "강원", "강원특별자치도": "강원",
    "충청북도": "충북", "충청남도": "충남", "전라북도": "전북", "전북특별자치도": "전북",
    "전라남도": "전남", "경상북도": "경북", "경상남도": "경남", "제주특별자치도": "제주",
}
EMPLOYMENT_AGE_IDX = {
    "15-19세": 3, "20-24세": 4, "25-29세": 5, "30-34세": 6, "35-39세": 7, "40-44세": 8,
    "45-49세": 9, "50-54세": 10, "55-59세": 11, "60-64세": 12, "65-69세": 13,
    "70세 이상": 14,
}

# Census text patterns and the number of five-year columns.
CENSUS_SUBTOTAL_PATTERN = r"\s\(\d{10}\)$"
CENSUS_AREA_PATTERN = r"^(.+?)\((\d{10})\)$"
CENSUS_AGE_COLUMN_PATTERN = r"^\d{4}년\d{2}월_계_(\d+)(?:~\d+세|세 이상)$"
CENSUS_AGE_COLUMNS = 21
CENSUS_AREA_COLUMN = "행정구역"

# Straight-line distance bands in metres.
DISTANCE_BANDS = [
    (2000, "1) 0-2km"), (5000, "2) 2-5km"), (10000, "3) 5-10km"),
    (20000, "4) 10-20km"), (None, "5) 20km+"),
]
# Fixed values: (metres per distance unit, minutes per time unit) of each hypothesis.
SPEED_HYPOTHESES = {
    "dist_m_time_min": (1, 1), "dist_m_time_10min": (1, 10),
    "dist_100m_time_min": (100, 1), "dist_100m_time_10min": (100, 10),
}
