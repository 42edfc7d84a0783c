"""Dimensions, thresholds and word lists. Nothing here reads the clock: jobs take `as_of`."""

from __future__ import annotations

AS_OF = "2024-02-01 00:00:00"
AS_OF_DATE = AS_OF[:10]

# Lanes in declared order; the order is the priority of the cross-source fold.
LANES = ["model", "official", "apps", "paper", "community", "media", "cn", "hot"]
# Hours a lane looks back.
LANE_HOURS = {"model": 504, "official": 168, "paper": 72, "community": 48, "media": 96, "cn": 72, "hot": 72}
DEFAULT_HOURS = 48

# Thresholds.
TAKE, MIN_TAKE = 8, 3
BRIEF_TAKE = 20  # of the queries over a whole brief
FLOOR_TOP, FLOOR_WATCH, FLOOR_KEYWORD, KEYWORD_BONUS = 8.0, 6.5, 7.0, 1.0
TOP_MAX, TOP_MIN, TOP_PERCENT, WATCH_PERCENT = 15, 4, 12, 35
CASE_MIN_TOTAL, CASE_MIN_REL, CASE_MAX, RESCORE_MAX, HALF_LIFE_DAYS = 6.0, 5, 300, 30, 21
SIM_TITLE, SIM_HOST, HOST_HOURS = 55, 25, 6  # similarities in hundredths

# Base of the fallback total per lane, in tenths.
FALLBACK_TENTHS = {"model": 90, "official": 76, "apps": 66, "paper": 62, "cn": 62, "community": 54, "media": 54, "hot": 64}

# Words that raise an item.
TOP_KEYWORDS = [
    "开源", "融资", "收购", "并购", "ipo", "反垄断", "监管", "open-source", "open source", "open weights", "open-weight",
    "release", "benchmark", "state-of-the-art", "sota", "breakthrough", "acquisition", "acquires", "raises", "funding round",
    "general availability",
]

# A digest has a column word and a colon, and no word for making.
NONWORK_COLUMN = "早报|晚报|日报|周报|月报|晨报|午报|新闻汇|快讯"
NONWORK_MADE = "做了|开发了|构建|实现|搭建|写了|开源|造了|整了|弄了|上线了"
NONWORK_LABEL, DEFAULT_TYPE = "非作品", "效率工具"

# Form of an application by keyword, first match wins.
TYPE_RULES = {
    "浏览器插件": ["浏览器插件", "浏览器扩展", "extension", "userscript", "油猴", "tampermonkey", "chrome 插件", "插件"],
    "移动 App": ["小程序", "安卓", "android", "ios", "手机 app", "手机端", "移动端", "app store", "鸿蒙"],
    "CLI 工具": ["cli", "命令行", "终端工具", "shell 脚本", "npm i", "pip install", "安装即用", "一行命令"],
    "Agent 工作流": ["agent", "智能体", "工作流", "workflow", "mcp", "multi-agent", "自动化流程", "编排"],
    "桌面工具": ["桌面应用", "desktop", "mac app", "windows app", "客户端", "macos"],
    "数据分析": ["看板", "dashboard", "可视化", "图表", "数据分析", "报表", "统计", "csv", "excel"],
    "模型与推理": ["微调", "量化", "推理", "训练", "fine-tun", "gguf", "权重", "benchmark", "评测", "模型权重"],
    "内容生成": ["写作", "摘要", "翻译", "生成器", "作图", "视频生成", "播客", "漫画", "语音合成", "图像生成", "绘图"],
    "Web 应用": ["网站", "web 应用", "网页", "在线工具", "saas", "landing page"],
}

# Section of a list -> fine category, as stored.
FINE_TYPES = {
    "agent skills": "Agent 技能",
    "starter ai agents": "入门 Agent",
    "advanced ai agents": "进阶 Agent",
    "always-on agents": "常驻 Agent",
    "multi-agent teams": "多 Agent 协作",
    "voice ai agents": "语音 Agent",
    "generative ui and agentic frontends": "生成式 UI",
    "autonomous game-playing agents": "游戏 Agent",
    "mcp ai agents": "MCP Agent",
    "rag (retrieval augmented generation)": "RAG 检索增强",
    "ai browser tools": "浏览器工具",
    "llm apps with memory": "带记忆的应用",
    "chat with x": "数据问答",
    "llm optimization tools": "推理优化",
    "llm fine-tuning": "微调",
    "ai agent framework crash courses": "框架教程",
}

# Section of a list -> coarse category.
COARSE_TYPES = {
    "agent skills": "Agent 技能",
    "starter ai agents": "Agent 工作流",
    "advanced ai agents": "Agent 工作流",
    "always-on agents": "Agent 工作流",
    "multi-agent teams": "Agent 工作流",
    "voice ai agents": "Agent 工作流",
    "autonomous game-playing agents": "Agent 工作流",
    "mcp ai agents": "Agent 工作流",
    "generative ui and agentic frontends": "Web 应用",
    "rag (retrieval augmented generation)": "RAG 检索增强",
    "chat with x": "RAG 检索增强",
    "llm apps with memory": "RAG 检索增强",
    "ai browser tools": "浏览器插件",
    "llm optimization tools": "模型与推理",
    "llm fine-tuning": "模型与推理",
    "ai agent framework crash courses": "教程与学习",
}

# Words that tell a quota error.
QUOTA_HINTS = ["429", "too many requests", "quota", "rate limit", "resource_exhausted", "capacity", "overloaded"]
