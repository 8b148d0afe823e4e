"""Pattern packs and the predicates over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word lists and patterns that results depend on.

NOISE = {
    "zh": ("", "好的", "好", "收到", "谢谢", "感谢", "嗯", "哦", "ok", "OK", "明白", "明白了", "知道了", "可以", "行", "是", "嗯嗯", "👌", "👍"),
    "en": ("", "ok", "okay", "yes", "no", "thanks", "thank you", "got it", "hi", "hello"),
}
QUESTION = {
    "zh": (
        r"[?？]", r"为什么", r"怎么", r"怎样", r"如何", r"能不能", r"可不可以", r"可以不", r"有没有", r"是不是", r"什么原因", r"什么情况", r"哪里", r"在哪",
        r"多少", r"什么时候", r"咋", r"我这里", r"我这边", r"看不到", r"没显示", r"没有显示", r"打不开", r"不能", r"不行", r"报错", r"失败", r"怎么设置",
    ),
    "compact": (r"[?？]", "为什么", "怎么", "怎样", "如何", "能不能", "可不可以", "有没有", "是不是", "什么", "哪里", "多少", "失败", "报错", "不行", "看不到"),
    "en": (r"\?", r"(?i)\b(?:how|what|why|where|which|when|who)\b", r"(?i)\b(?:can|could|does|is|are) (?:i|we|you|it|the)\b"),
}
ANSWER = {
    "zh": (
        "这个是因为", "因为", "需要", "建议", "可以在", "可以去", "可以通过", "你可以", "您可以", "你这边", "您这边", "在设置", "设置里面", "我们这边", "我这边看", "这边看了",
        "看了一下", "已经处理", "已经修复", "已经好了", "处理好了", "帮你", "帮您", "给你", "给您", "稍后", "刷新一下", "重新登录", "重新进入", "重新操作", "操作一下", "同步一下",
        "更新一下", "确认一下", "检查一下", "麻烦", "正常的", "目前是", "目前这个", "这个功能", "系统会", "系统是", "逻辑是", "规则是",
    ),
    "en": (r"(?i)\bbecause\b", r"(?i)\byou can\b", r"(?i)\bplease\b", r"(?i)\bthe\b.*\bis\b"),
}
INTERNAL = {
    "zh": (
        "接口", "日志", "数据库", "代码", "服务", "服务器", "发布", "上线", "版本", "测试环境", "生产环境", "开发", "研发", "技术排查", "排查", "bug", "BUG", "需求",
        "产品确认", "产品那边", "技术那边", "后端", "前端", "SQL", "sql",
    ),
    "en": (r"(?i)\b(?:api|log|database|deploy|server|release|bug)\b",),
}
SENSITIVE = {
    "phone": r"(?<!\d)1[3-9]\d{9}(?!\d)",
    "api_key": r"(?i)(api[_-]?key|secret|password)\s*[:=]\s*\S+",
    "env_path": r"(?:^|/)\.env(?:\.|$)",
}
CONFLICT_WORDS = ("不支持", "不能", "禁止", "已取消", "不可以")
GENERIC_CUSTOMERS = ("客户", "客户方", "顾客", "用户", "车主")
GENERIC_SYSTEMS = ("系统", "群助手", "助手", "机器人", "system")
CAUTION = ("暂时", "目前", "近期", "以后", "后续", "temporarily", "currently", "for now")


def any_of(c: Column, patterns: Sequence[str]) -> Column:
    return c.rlike("|".join(f"(?:{p})" for p in patterns))


def is_question(c: Column, pack: str = "zh") -> Column:
    return any_of(c, QUESTION[pack])


def is_noise(c: Column, pack: str = "zh") -> Column:
    return c.isin(*NOISE[pack]) | c.rlike(r"^@\S+$") | (F.length(c) <= 1)


def hits(c: Column, patterns: Sequence[str]) -> Column:
    """How many of the patterns match, not how often."""
    return reduce(lambda a, b: a + b, (c.rlike(p).cast("int") for p in patterns))


def sensitive(c: Column, patterns: Mapping[str, str] = SENSITIVE) -> Column:
    """Names of the kinds of sensitive content found."""
    return F.array_compact(F.array(*(F.when(c.rlike(p), F.lit(n)) for n, p in patterns.items())))


def flags(**rules: Column) -> Column:
    """Names of the rules that hold, in the order given; null counts as not holding."""
    return F.array_compact(F.array(*(F.when(F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items())))


def has_any(c: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(c, F.lit(w)) for w in words))


def ladder(*rungs: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first rung that holds."""
    first, *rest = rungs
    out = F.when(first[0], first[1])
    for condition, value in rest:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def clamp_enum(c: Column, allowed: Sequence[str], default: str) -> Column:
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))
