"""Fixed values of the title domain."""

#: Rank suffixes, in the order in which they are tried.
RANKS = ["王", "侯", "公", "伯", "子", "男", "帝", "太子", "皇后", "太后", "太妃"]
#: Sections that hold no holders.
PARSE_SKIP = ["参考资料", "參考資料", "参见", "參見", "相关条目", "相關條目", "外部链接", "外部連結", "注释", "註釋", "脚注", "腳註"]
#: Sections whose rows are kept but marked.
MARK_SKIP = [*PARSE_SKIP[:6], "諡號", "谥号", "封號", "封号", "封爵", "庙号", "廟號", "爵位", "头衔", "頭銜"]
#: Ranks that combine with surnames to patterns.
PATTERN_RANKS = ["王", "公", "侯", "伯", "子", "男"]
#: Section header to candidate dynasties.
DYNASTIES = {
    "汉朝": ["東漢", "西漢", "漢"], "漢朝": ["東漢", "西漢", "漢"], "东汉": ["東漢", "漢"], "東漢": ["東漢", "漢"], "西汉": ["西漢", "漢"],
    "曹魏": ["三國魏", "魏"], "三国": ["三國魏", "三國蜀", "三國吳", "三國"], "三國": ["三國魏", "三國蜀", "三國吳", "三國"],
    "西晋": ["西晉", "晉"], "西晉": ["西晉", "晉"], "东晋": ["東晉", "晉"], "東晉": ["東晉", "晉"], "晋朝": ["西晉", "東晉", "晉"], "晉朝": ["西晉", "東晉", "晉"],
    "南北朝": ["南北朝", "劉宋", "南齊", "南梁", "陳", "北魏", "東魏", "西魏", "北齊", "北周"], "北魏": ["北魏", "拓跋魏"], "东魏": ["東魏"], "東魏": ["東魏"],
    "西魏": ["西魏"], "北齐": ["北齊"], "北齊": ["北齊"], "北周": ["北周"], "隋朝": ["隋"], "隋": ["隋"], "唐朝": ["唐"], "唐": ["唐"], "宋朝": ["宋", "北宋"],
    "宋": ["宋", "北宋"], "元朝": ["元"], "元": ["元"], "明朝": ["明"], "明": ["明"], "清朝": ["清"], "清": ["清"], "高丽": ["高麗"], "高麗": ["高麗"],
    "朝鮮": ["朝鮮"], "新罗": ["新羅"], "新羅": ["新羅"],
}
WIKI_SOURCE = "zh.wikipedia"
WIKI_URL = "https://zh.wikipedia.org/wiki/"
