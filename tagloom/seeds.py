"""Rule sets of the seeded catalogue.

Fixed values: tag ids and rule texts must equal the ones stored in existing
profiles and source tables, so they are written out as they are.
"""

from __future__ import annotations

from tagloom.specs import Rule, rules

# --- fixed values: equality rules (rule text, tag id)
GENDER = rules([("1", 50), ("2", 51)])
ETHNICITY = rules([("0", 67), ("1", 68), ("2", 69), ("3", 70), ("4", 71), ("5", 72), ("6", 73)])
NATIVE_PLACE = rules(
    [("beijing", 74), ("shanghai", 75), ("guangzhou", 76), ("shenzhen", 77), ("hangzhou", 78), ("suzhou", 79)]
)
POLITICAL = rules([("1", 80), ("2", 81), ("3", 82)])
JOB = rules([("1", 83), ("2", 84), ("3", 85), ("4", 86), ("5", 87), ("6", 88)])
MARRIAGE = rules([("1", 89), ("2", 90), ("3", 91)])
EDUCATION = rules(
    [("小学", 92), ("初中", 93), ("高中", 94), ("大专", 95), ("本科", 96), ("硕士", 97), ("博士", 98)]
)
EMPLOYMENT = rules([("事业单位", 99), ("在职", 100), ("待业", 101), ("自主就业", 102)])
ZODIAC = rules(
    [
        ("aries", 103),
        ("taurus", 104),
        ("gemini", 105),
        ("cancer", 106),
        ("leo", 107),
        ("virgo", 108),
        ("libra", 109),
        ("scorpio", 110),
        ("sagittarius", 111),
        ("capricorn", 112),
        ("aquarius", 113),
        ("pisces", 114),
    ]
)
DISTRICT = rules(
    [("CBD", 115), ("西单", 116), ("王府井", 117), ("朝外", 118), ("三里屯", 119), ("徐家汇", 120), ("环球港", 121)]
)
NATIONALITY = rules(
    [("中国大陆", 122), ("中国香港", 123), ("中国澳门", 124), ("中国台湾", 125), ("其他", 126)]
)
PAYMENT = rules([("alipay", 143), ("wxpay", 144), ("chinapay", 145), ("cod", 146)])
COUPON = rules([("折扣券", 163), ("活动券", 164), ("积分换购", 165)])
PAGE = rules(
    [("登录页", 173), ("首页", 174), ("分类页", 175), ("商品页", 176), ("我的订单页", 177), ("订单物流页", 178)]
)
DEVICE = rules([("Windows", 186), ("Mac", 187), ("Linux", 188), ("Android", 189), ("IOS", 190)])
CATEGORY = rules(
    [
        ("彩电", 200),
        ("厨房电器", 201),
        ("热水器", 202),
        ("冰箱", 203),
        ("洗衣机", 204),
        ("生活小电", 205),
        ("水家电", 206),
        ("空调", 207),
        ("冷柜", 208),
    ]
)
BRAND = [
    Rule(209, "海尔", 1),
    Rule(210, "卡萨帝", 2),
    Rule(211, "摩卡", 3),
    Rule(212, "小超人", 4),
    Rule(213, "统帅", 5),
]
PROPERTY = rules([("有房无贷", 214), ("公积金贷款", 215), ("商业贷款", 216), ("无房", 217)])
CAR = rules([("有车无贷", 223), ("有车有贷", 224), ("无车", 225)])
SHOP_GENDER = [Rule(248, "1", 1), Rule(249, "2", 2)]

# --- fixed values: range rules (rule text, tag id)
AGE = rules(
    [
        ("19500101-19591231", 52),
        ("19600101-19691231", 53),
        ("19700101-19791231", 54),
        ("19800101-19891231", 55),
        ("19900101-19991231", 56),
        ("20000101-20091231", 57),
        ("20100101-20191231", 58),
        ("20200101-20291231", 59),
    ]
)
HEIGHT = rules(
    [
        ("150-159", 60),
        ("160-169", 61),
        ("170-179", 62),
        ("180-189", 63),
        ("190-199", 64),
        ("200-209", 65),
        ("210-240", 66),
    ]
)
CYCLE = rules([("0-7", 127), ("8-14", 128), ("15-30", 129), ("31-60", 130), ("61-90", 131)])
SPENDING = [
    Rule(132, "50000-1000000", 1),
    Rule(133, "40000-49999", 2),
    Rule(134, "30000-39999", 3),
    Rule(135, "20000-29999", 4),
    Rule(136, "10000-19999", 5),
    Rule(137, "1000-9999", 6),
    Rule(138, "1-999", 7),
]
ORDER_VALUE = rules([("1-999", 139), ("1000-2999", 140), ("3000-4999", 141), ("5000-9999", 142)])
LARGEST_ORDER = rules([("1-999", 147), ("1000-2999", 148), ("3000-4999", 149), ("5000-9999", 150)])
DISCOUNT_DEPTH = rules([("0.3-0.4", 160), ("0.5-0.7", 161), ("0.8-0.9", 162)])
LAST_LOGIN = rules([("1day", 169), ("7day", 170), ("14day", 171), ("30day", 172)])
VISIT_SECONDS = rules([("<60second", 179), ("60second-299second", 180), (">300second", 181)])
BROWSING_HOURS = rules([("1-7", 191), ("8-12", 192), ("13-17", 193), ("18-21", 194), ("22-24", 195)])
PROPERTY_VALUE = rules(
    [
        ("0-499999", 218),
        ("500000-999999", 219),
        ("1000000-1999999", 220),
        ("2000000-4999999", 221),
        (">5000000", 222),
    ]
)
CAR_VALUE = rules(
    [
        ("1-99999", 226),
        ("100000-199999", 227),
        ("200000-299999", 228),
        ("300000-499999", 229),
        ("500000-699999", 230),
        ("700000-999999", 231),
        (">1000000", 232),
    ]
)
PSM = [
    Rule(234, ">=1", 1),
    Rule(235, "0.4~1", 2),
    Rule(236, "0.1-0.3", 3),
    Rule(237, "0", 4),
    Rule(238, "<0", 5),
]
ACTIVITY = [Rule(240, ">=1", 1), Rule(241, "0.6-0.9", 2), Rule(242, "0.2-0.5", 3), Rule(243, "<0-0.1", 4)]
SPEND_POWER = [1555, 1556, 1557]

# --- fixed values: score bands (band text, score)
RFM_RECENCY = rules([("1-3", 5), ("4-6", 4), ("7-9", 3), ("10-15", 2), (">=16", 1)])
RFM_FREQUENCY = rules([(">=200", 5), ("150-199", 4), ("100-149", 3), ("50-99", 2), ("1-49", 1)])
RFM_MONETARY = rules(
    [(">=200000", 5), ("100000-199999", 4), ("50000-99999", 3), ("10000-49999", 2), ("<=9999", 1)]
)
RFE_RECENCY = rules([("0-3", 5), ("4-6", 4), ("7-9", 3), ("10-15", 2), (">=16", 1)])
RFE_FREQUENCY = rules([(">=400", 5), ("300-399", 4), ("200-299", 3), ("100-199", 2), ("0-99", 1)])
RFE_ENGAGEMENT = rules([(">=250", 5), ("230-249", 4), ("210-229", 3), ("200-209", 2), ("<=100", 1)])
SIX_RECENCY = rules([("<=1", 6), ("2-3", 5), ("4-5", 4), ("6-7", 3), ("8-14", 2), (">=15", 1)])
SIX_FREQUENCY = rules([(">=10", 6), ("8-9", 5), ("6-7", 4), ("4-5", 3), ("2-3", 2), ("1", 1)])
SIX_ENGAGEMENT = rules([(">=6", 6), ("5", 5), ("4", 4), ("3", 3), ("2", 2), ("1", 1)])

# --- fixed values: codes 1..20 of the goods colours, in code order
COLOURS = (
    "银色",
    "香槟金色",
    "黑色",
    "白色",
    "梦境极光【卡其金】",
    "梦境极光【布朗灰】",
    "粉色",
    "金属灰",
    "金色",
    "乐享金",
    "布鲁钢",
    "月光银",
    "时尚光谱【浅金棕】",
    "香槟色",
    "香槟金",
    "灰色",
    "樱花粉",
    "蓝色",
    "金属银",
    "玫瑰金",
)
# --- fixed values: codes of the product types; 11 has no text of its own
PRODUCT_TYPES = {
    "4K电视": 9,
    "Haier/海尔冰箱": 10,
    "LED电视": 12,
    "Leader/统帅冰箱": 13,
    "冰吧": 14,
    "冷柜": 15,
    "净水机": 16,
    "前置过滤器": 17,
    "取暖电器": 18,
    "吸尘器/除螨仪": 19,
    "嵌入式厨电": 20,
    "微波炉": 21,
    "挂烫机": 22,
    "料理机": 23,
    "智能电视": 24,
    "波轮洗衣机": 25,
    "滤芯": 26,
    "烟灶套系": 27,
    "烤箱": 28,
    "燃气灶": 29,
    "燃气热水器": 30,
    "电水壶/热水瓶": 31,
    "电热水器": 32,
    "电磁炉": 33,
    "电风扇": 34,
    "电饭煲": 35,
    "破壁机": 36,
    "空气净化器": 37,
}
COLOUR_CODES = {name: code for code, name in enumerate(COLOURS, start=1)}
# --- fixed values: goods that vote female
FEMALE_COLOURS = ("樱花粉", "白色", "香槟色", "香槟金")
FEMALE_TYPES = ("料理机", "挂烫机", "吸尘器/除螨仪")

# --- fixed values: number of TAB fields per line kind
TSV_FIELDS = {"user": 37, "product": 371, "product_type": 7, "order": 109, "log": 11}

# --- fixed values: composite tags as (composite id, [(member tag, connector)])
COMPOSITES = [
    (1, [(97, "or"), (98, "and"), (132, "or"), (133, "and"), (214, "and")]),
    (2, [(75, "and"), (134, "and"), (51, "and")]),
    (3, [(50, "and"), (137, "and"), (130, "and"), (217, "and"), (160, "and")]),
    (4, [(55, "and")]),
]

# --- fixed values: levels 1 to 4 of the tag tree (id, parent) and its names here
TREE = [
    (1, -1, "commerce"),
    (2, 1, "mall"),
    (3, 2, "demographics"),
    (4, 2, "spending"),
    (5, 2, "behaviour"),
    (6, 2, "value"),
    (8, 3, "gender"),
    (9, 3, "age band"),
    (10, 3, "height"),
    (11, 3, "ethnicity"),
    (12, 3, "native place"),
    (13, 3, "political face"),
    (14, 3, "job"),
    (15, 3, "marriage"),
    (16, 3, "education"),
    (17, 3, "employment"),
    (18, 3, "zodiac"),
    (19, 3, "business district"),
    (20, 3, "nationality"),
    (21, 4, "purchase cycle"),
    (22, 4, "spending band"),
    (23, 4, "average order"),
    (24, 4, "payment"),
    (25, 4, "largest order"),
    (29, 4, "discount depth"),
    (30, 4, "coupon type"),
    (33, 5, "last login"),
    (34, 5, "page type"),
    (35, 5, "visit duration"),
    (38, 5, "device"),
    (39, 5, "browsing hours"),
    (42, 5, "purchased goods"),
    (44, 5, "category preference"),
    (45, 5, "brand preference"),
    (46, 6, "property"),
    (47, 6, "property value"),
    (48, 6, "car"),
    (49, 6, "car value"),
    (233, 4, "price sensitivity"),
    (239, 5, "activity"),
    (244, 4, "shop gender"),
]

# Level-5 rules by the level-4 tag they belong to.
RULES_BY_TAG = {
    8: GENDER,
    9: AGE,
    10: HEIGHT,
    11: ETHNICITY,
    12: NATIVE_PLACE,
    13: POLITICAL,
    14: JOB,
    15: MARRIAGE,
    16: EDUCATION,
    17: EMPLOYMENT,
    18: ZODIAC,
    19: DISTRICT,
    20: NATIONALITY,
    21: CYCLE,
    22: SPENDING,
    23: ORDER_VALUE,
    24: PAYMENT,
    25: LARGEST_ORDER,
    29: DISCOUNT_DEPTH,
    30: COUPON,
    33: LAST_LOGIN,
    34: PAGE,
    35: VISIT_SECONDS,
    38: DEVICE,
    39: BROWSING_HOURS,
    44: CATEGORY,
    45: BRAND,
    46: PROPERTY,
    47: PROPERTY_VALUE,
    48: CAR,
    49: CAR_VALUE,
    233: PSM,
    239: ACTIVITY,
    244: SHOP_GENDER,
}
