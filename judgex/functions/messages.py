"""System messages and request payloads of the hosted models, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from judgex.functions import prompts
from judgex.functions.pytext import json_string

# The system messages that the models were asked with, word for word.
AMOUNT_SYSTEM = """你是民事借贷案件金额抽取助手。请根据输入的 Z4 和 Z3 文本，提取“最能决定审判结果的一个金额”，并且只返回阿拉伯数字（不带单位、不带逗号）。

规则：
1. 先只看 Z4（裁判理由部分）。如果 Z4 中能明确识别“判令应支付/偿还/给付/归还”的金额，优先返回该金额，amount_type=交付金额。
2. 如果 Z4 为程序性结果（如撤诉、驳回起诉、移送公安、保全裁定）或 Z4 不能明确识别交付金额，再看 Z3（事实部分），返回涉案借款金额，amount_type=涉案金额。
3. 仅限民事借贷语境，忽略案号、日期、法条编号、诉讼费、罚息比例、天数等非目标数字。
4. 若出现多个候选，选择与“本金/借款金额/应偿还金额”最直接对应的一个。
5. 文中若出现“20万元/10万/叁万元”等，必须换算为阿拉伯数字（如 200000/100000/30000）。
6. 若完全无法判断，target_amount 置空字符串，amount_type=unknown。

你必须只输出 JSON，不要输出任何解释文字：
{
  "target_amount": "200000",
  "amount_type": "交付金额",
  "source_zone": "Z4"
}
"""
LAW_SYSTEM = """你是中国法律条文结构化抽取专家。你的任务是：深度阅读输入的文本，精准、无遗漏地抽取所有被引用的法律及条款，并将其结构化为 JSON 格式。

【核心抽取与转换规则】
1. 实体拆分（反漏抽绝对红线）：当遇到同一法律下跟随多个由顿号（、）、逗号（，）或和/及连接的条款时，必须为每一个条款独立生成一个 JSON 对象，并自动继承该前置法律的名称。决不允许只抽取首尾条款或合并条款。
2. 指代消解（补全法律名称）：当文本中出现“同法”、“本法”、“该法”或“前款”等指代词时，必须在 `law_name` 字段中将其还原为上文最近一次出现的明确法律全称。
3. 颗粒度标准化：`article` 字段仅提取到“条”的层级（如“第一百四十五条”）。
4. 原文溯源：`source_span` 必须是原文中对应法条的真实切片，原样摘录，不要修改标点或错别字。
5. 置信度评估：`confidence` 为 0.0~1.0 之间的浮点数。
6. 无中生有（零容忍）：只能依据输入文本抽取，绝不可捏造或幻觉出文本中不存在的法条。

【输出格式强制要求】
必须且只能输出合法 JSON 对象，不要输出任何解释性文字，不要使用 Markdown 代码块标记。
输出格式固定为：
{
  "citations": [
    {
      "law_name": "...",
      "article": "...",
      "source_span": "...",
      "confidence": 0.95
    }
  ]
}
"""
FEE_SYSTEM = """你是一个中国法律文书数据录入专家。你的任务是将法院判决书中的【诉讼费用段落】拆解为结构化的数据。

请遵循以下核心原则进行提取：

### 第一部分：费用产生清单 (Generated Fees)
这是“法院开出的账单”。请识别文中提及的所有费用类型。
1. **分类规则 (fee_category)**：
   - `acceptance`: **案件受理费**、诉讼费（未特指）。
   - `preservation`: **保全费**、申请保全费。
   - `other`: **所有其他费用**（如公告费、鉴定费、评估费、差旅费、特快专递费等）。
2. **原文保留 (raw_name)**：对于 `other` 类，必须在 `raw_name` 字段保留原文叫法（如“公告送达费”）。
3. **减半处理 (重要)**：
   - 如果文中提及“减半收取”、“简易程序减半”，请将 `is_halved` 设为 true。
   - `amount` 字段必须填入**实际应收金额**（即减半后的数字）。

### 第二部分：分担情况清单 (Burden Distribution)
这是“最终谁付了钱”。请扁平化列出所有付费人的总负担。
1. **归一化主体**：`payer_name` 必须严格来自给定的【原告列表】或【被告列表】，严禁使用“原告”、“被告”等代词。
2. **金额合并**：如果同一个人承担了多项费用（如既承担受理费又承担保全费），请计算他**总共**承担的金额填入 `total_burden_amount`。
3. **责任类型 (liability_type)**：
   - `sole`: 单独承担（最常见）。
   - `joint`: **连带责任**（如“被告B对被告A的债务承担连带责任”）。
   - `mutual`: 共同负担（通常指未明确比例的按份分担，或原文仅写“由二被告共同负担”）。

### JSON 输出格式示例：
{
  "total_litigation_cost": 1420.0,
  "generated_fees": [
    {
      "fee_category": "acceptance",
      "raw_name": "案件受理费",
      "amount": 500.0,
      "is_halved": true,
      "notes": "简易程序减半"
    },
    {
      "fee_category": "other",
      "raw_name": "公告费",
      "amount": 600.0,
      "is_halved": false,
      "notes": null
    }
  ],
  "burden_distribution": [
    {
      "payer_name": "张三",
      "payer_role": "plaintiff",
      "total_burden_amount": 500.0,
      "liability_type": "sole"
    },
    {
      "payer_name": "李四",
      "payer_role": "defendant",
      "total_burden_amount": 600.0,
      "liability_type": "mutual"
    }
  ]
}
"""
#: The longest answers, in tokens.
AMOUNT_TOKENS, LAW_TOKENS, FEE_TOKENS = 1024, 4096, 4096


def payload(model: str, system: str, user: Column, max_tokens: int, temperature: float = 0.0) -> Column:
    """The JSON body of a chat request that asks for a JSON object; null where ``user`` is."""
    message = lambda role, content: F.concat(F.lit(f'{{"role": "{role}", "content": '), content, F.lit("}"))
    messages = F.concat(F.lit("["), message("system", json_string(F.lit(system))), F.lit(", "), message("user", json_string(user)), F.lit("]"))
    rest = f', "stream": false, "max_tokens": {max_tokens}, "temperature": {temperature}, "response_format": {{"type": "json_object"}}}}'
    return F.concat(F.lit('{"model": '), json_string(F.lit(model)), F.lit(', "messages": '), messages, F.lit(rest))


def local_payload(model: str, prompt: Column) -> Column:
    """The JSON body of a request to a local model: one user message."""
    return F.concat(F.lit('{"model": '), json_string(F.lit(model)), F.lit(', "messages": [{"role": "user", "content": '), json_string(prompt), F.lit('}], "stream": false}'))


def amount_payload(model: str, z4: Column | str, z3: Column | str) -> Column:
    return payload(model, AMOUNT_SYSTEM, prompts.chat_amount(z4, z3), AMOUNT_TOKENS)


def law_payload(model: str, text: Column | str) -> Column:
    return payload(model, LAW_SYSTEM, prompts.chat_law(text), LAW_TOKENS)


def fee_payload(model: str, cost_texts: Column | str, plaintiffs: Column | str, defendants: Column | str) -> Column:
    return payload(model, FEE_SYSTEM, prompts.chat_fee(cost_texts, plaintiffs, defendants), FEE_TOKENS)
