"""Fixed values.

The word lists, codes, labels and limits below are data, not logic: a listing is
classified the same way everywhere only when they are the same everywhere. Where a
list is searched in order (brands, colours, keywords) its order is part of the value.
"""

# Brand names, searched in this order.
BRANDS = [
    "奥迪", "宝马", "奔驰", "大众", "丰田", "本田", "日产", "马自达", "现代", "起亚", "福特", "雪佛兰", "别克", "凯迪拉克", "沃尔沃",
    "捷豹", "路虎", "保时捷", "特斯拉", "比亚迪", "吉利", "长城", "奇瑞", "长安", "荣威", "名爵", "传祺", "红旗", "领克", "蔚来",
    "小鹏", "理想", "威马", "零跑", "哪吒", "极氪", "岚图", "高合", "智己", "雷克萨斯", "英菲尼迪", "讴歌", "林肯", "克莱斯勒",
    "Jeep", "道奇", "菲亚特", "阿尔法罗密欧", "玛莎拉蒂", "法拉利", "兰博基尼", "宾利", "劳斯莱斯", "阿斯顿马丁", "迈凯伦", "布加迪",
    "帕加尼", "柯尼塞格", "五菱", "宝骏", "东风", "一汽", "北汽", "江淮", "海马", "众泰", "力帆", "观致", "启辰", "思铭", "理念",
]

UNKNOWN_BRAND = "未知品牌"

# Names of city codes.
CITY_NAMES = {
    "beijing": "北京", "bj": "北京", "shanghai": "上海", "sh": "上海", "guangzhou": "广州", "gz": "广州",
    "shenzhen": "深圳", "sz": "深圳", "hangzhou": "杭州", "hz": "杭州", "nanjing": "南京", "nj": "南京",
    "wuhan": "武汉", "wh": "武汉", "chengdu": "成都", "cd": "成都", "xian": "西安", "xa": "西安",
    "chongqing": "重庆", "cq": "重庆", "tianjin": "天津", "tj": "天津", "qingdao": "青岛", "qd": "青岛",
    "dalian": "大连", "dl": "大连", "suzhou": "苏州", "su": "苏州", "dongguan": "东莞", "dg": "东莞",
    "foshan": "佛山", "fs": "佛山", "zhengzhou": "郑州", "zz": "郑州", "changsha": "长沙", "cs": "长沙",
    "jinan": "济南", "jn": "济南", "hefei": "合肥", "hf": "合肥", "shenyang": "沈阳", "sy": "沈阳",
    "changchun": "长春", "cc": "长春", "harbin": "哈尔滨", "hrb": "哈尔滨", "taiyuan": "太原", "ty": "太原",
    "taizhou": "台州", "tz": "台州", "taizhou_zj": "台州", "ningbo": "宁波", "nb": "宁波", "wuxi": "无锡",
    "wx": "无锡", "changzhou": "常州", "xuzhou": "徐州", "yantai": "烟台", "weifang": "潍坊", "linyi": "临沂",
    "zibo": "淄博", "weihai": "威海", "dongying": "东营", "binzhou": "滨州", "dezhou": "德州",
    "liaocheng": "聊城", "heze": "菏泽", "zaozhuang": "枣庄", "jining": "济宁", "taian": "泰安",
    "rizhao": "日照", "laiwu": "莱芜", "huaian": "淮安", "yancheng": "盐城", "yangzhou": "扬州",
    "zhenjiang": "镇江", "suqian": "宿迁", "lianyungang": "连云港", "shaoxing": "绍兴", "jiaxing": "嘉兴",
    "huzhou": "湖州", "lishui": "丽水", "quzhou": "衢州", "zhoushan": "舟山", "wenzhou": "温州",
    "kunming": "昆明", "km": "昆明", "lanzhou": "兰州", "lz": "兰州", "urumqi": "乌鲁木齐", "guiyang": "贵阳",
    "gy": "贵阳", "nanning": "南宁", "nn": "南宁", "haikou": "海口", "hk": "海口", "shijiazhuang": "石家庄",
    "sjz": "石家庄", "hohhot": "呼和浩特",
}

# City codes of a default collection run, in collection order.
RUN_CITIES = [
    "bj", "sh", "gz", "sz", "hz", "nj", "wh", "cd", "xa", "cq", "tj", "qd", "dl", "su", "dg", "fs",
    "zz", "cs", "jn", "hf", "sy", "cc", "hrb", "nb", "wx", "tz", "km", "lz", "urumqi", "gy", "nn",
    "hk", "sjz", "taiyuan", "hohhot", "changchun",
]

# Category path segments of a city, in collection order.
CATEGORIES = ["", "suv/", "mpv/", "pickup/", "coupe/"]

# Collection limits.
MAX_PAGES = 50
CITY_MIN = 200
CITY_MAX = 1500
RUN_TARGET = 20000
LARGE_TARGET = 15000
SPARE_CITIES = 5

# Elements that hold a listing card, and elements that hold its title, by preference.
CARD_SELECTORS = ["li.cards-li", ".list-item", ".car-item", ".item-info"]
TITLE_SELECTORS = ["[carname]", "h4", ".card-name", ".car-name", ".title"]

COLORS = "白色 黑色 银色 灰色 红色 蓝色 金色 棕色 绿色 黄色 橙色 紫色".split()

AUTOMATIC, MANUAL, CVT, DUAL_CLUTCH = "自动", "手动", "CVT", "双离合"
TRANSMISSION_WORDS = [
    (AUTOMATIC, ["自动", "AT"]),
    (MANUAL, ["手动", "MT"]),
    (CVT, ["CVT"]),
    (DUAL_CLUTCH, ["双离合", "DCT"]),
]

ELECTRIC, PLUG_IN, HYBRID, PETROL = "电动", "插电混动", "混动", "汽油"
ELECTRIC_BRANDS = "特斯拉 蔚来 小鹏 理想 威马 零跑 哪吒".split()
FUEL_WORDS = [
    (ELECTRIC, ["EV", "电"]),
    (PLUG_IN, ["PHEV", "DM", "插电"]),
    (HYBRID, ["HEV", "混动"]),
]

SUV, MPV, SEDAN = "SUV", "MPV", "轿车"
VEHICLE_WORDS = [
    (SUV, "SUV X Q GL GLE RX NX CX CR RAV XC QX".split()),
    (MPV, "MPV GL8 ODYSSEY SIENNA ALPHARD ELYSION".split()),
]

# Half-open bands: (upper bound, label); the last label has no upper bound.
PRICE_BANDS = [(10, "10万以下"), (20, "10-20万"), (30, "20-30万"), (50, "30-50万"), (100, "50-100万"), (None, "100万以上")]
MILEAGE_BANDS = [
    (10000, "1万公里以下"),
    (30000, "1-3万公里"),
    (50000, "3-5万公里"),
    (100000, "5-10万公里"),
    (None, "10万公里以上"),
]

# Text patterns of a card; group 1 is the number.
YEAR_PATTERNS = [r"(\d{4})款", r"(\d{4})年", r"(\d{4})-"]
MILEAGE_WAN_PATTERN = r"([\d.]+)万公里"
MILEAGE_KM_PATTERN = r"([\d.]+)公里"
DISPLACEMENT_PATTERN = r"([\d.]+)[LT]"
PRICE_PATTERN = r"([\d.]+)万"
PRICE_NOT_DISTANCE_PATTERN = r"([\d.]+)万(?:[^公]|$)"
PRICE_FREE_PATTERN = r"([\d.]+)"
CONDITION_PATTERNS = [r"车况[：:]?([\d.]+)分", r"评分[：:]?([\d.]+)"]
CONSUMPTION_PATTERNS = [r"油耗[：:]?([\d.]+)L", r"([\d.]+)L/100km"]
TOP_SPEED_PATTERNS = [r"最高时速[：:]?([\d.]+)", r"([\d.]+)km/h"]
ACCELERATION_PATTERNS = [r"加速[：:]?([\d.]+)秒", r"0-100km/h[：:]?([\d.]+)s"]

# Validity ranges, inclusive.
PRICE_RANGE = (0.1, 2000)
YEAR_RANGE = (2000, 2025)
MILEAGE_RANGE = (0, 1000000)
DISPLACEMENT_RANGE = (0.5, 8.0)

REFERENCE_YEAR = 2024
SOURCE = "车168"
OTHER = "其他"

# Cell texts that a CSV reader takes as missing.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Price tiers, cheapest first, and the quantiles between them.
TIERS = ["经济型", "中档型", "豪华型"]
TIER_QUANTILES = [0.33, 0.67]

# Grades, best first, and the (high, low) limits by measure.
GRADES = ["优秀", "良好", "一般"]
R2_LIMITS = (0.8, 0.6)
ACCURACY_LIMITS = (0.85, 0.75)

CLUSTER_PREFIX = "聚类"
