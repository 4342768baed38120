"""Han characters of several Mandarin readings, written down by hand and not checked against a published list."""

from __future__ import annotations

# Simplified characters with their readings, without tones and with u for ü, as readings are compared. Readings that differ in tone alone
# and neutral suffixes are left out. No list of names has a part in the choice.
_LISTED = """
阿 a e;艾 ai yi;拗 ao niu;凹 ao wa;扒 ba pa;耙 ba pa;柏 bai bo;膀 bang pang;蚌 bang beng;磅 bang pang;炮 pao bao;刨 pao bao;堡 bao bu pu;暴 bao pu;曝 pu bao;瀑 pu bao;趵 bao bo;薄 bao bo;剥 bao bo;
般 ban bo pan;孛 bei bo;陂 bei pi po;臂 bi bei;贲 ben bi;夯 hang ben;栟 bing ben;辟 pi bi;埤 pi bi;裨 bi pi;秘 mi bi;泌 mi bi;扁 bian pian;便 bian pian;缏 bian pian;骠 piao biao;杓 shao biao;玢 bin fen;屏 ping bing;
伯 bo bai;泊 bo po;卜 bu bo;魄 po tuo bo;蕃 fan bo;埔 pu bu;藏 cang zang;伧 cang chen;参 can cen shen;孱 chan can;侧 ce ze zhai;曾 zeng ceng;噌 ceng cheng;差 cha chai ci;查 cha zha;楂 zha cha;刹 sha cha;喳 zha cha;
禅 chan shan;单 dan chan shan;颤 chan zhan;裳 chang shang;倘 tang chang;厂 chang an;广 guang an;长 chang zhang;嘲 chao zhao;朝 chao zhao;绰 chuo chao;剿 jiao chao;车 che ju;尺 chi che;称 cheng chen;沈 shen chen;谌 chen shen;
乘 cheng sheng;盛 sheng cheng;晟 sheng cheng;澄 cheng deng;铛 dang cheng;匙 chi shi;坻 chi di;郗 xi chi;眙 yi chi;重 zhong chong;种 zhong chong;涌 yong chong;臭 chou xiu;仇 chou qiu;畜 chu xu;褚 chu zhu;啜 chuo chuai;
嘬 zuo chuai;传 chuan zhuan;幢 zhuang chuang;椎 zhui chui;衰 shuai cui;伺 si ci;兹 zi ci;茈 zi ci chai;枞 cong zong;攒 zan cuan;卒 zu cu;酢 zuo cu;撮 cuo zuo;沓 ta da;大 da dai;骀 tai dai;石 shi dan;弹 dan tan;澹 dan tan;
掸 dan shan;疸 da dan;叨 dao tao;焘 dao tao;得 de dei;地 di de;的 de di;底 di de;提 ti di;翟 zhai di;佃 dian tian;钿 dian tian;阽 dian yan;调 diao tiao;铫 diao yao;鸟 niao diao;揲 die she;丁 ding zheng;町 ting ding;
铤 ting ding;洞 dong tong;峒 tong dong;硐 dong tong;侗 dong tong;垌 dong tong;恫 dong tong;都 du dou;读 du dou;碡 zhou du;度 du duo;驮 tuo duo;囤 tun dun;敦 dun dui;沌 dun zhuan;顿 dun du;恶 e wu;阏 e yan;哦 o e;
佴 er nai;番 fan pan;繁 fan po;佛 fo fu;否 fou pi;脯 fu pu;冯 feng ping;轧 zha ya ga;伽 ga jia qie;夹 jia ga;咖 ka ga;胳 ge ga;呷 xia ga;盖 gai ge;胲 hai gai;镐 gao hao;蛤 ge ha;合 he ge;颌 he ge;鬲 ge li;咯 ge ka luo;
硌 ge luo;革 ge ji;给 gei ji;颈 jing geng;红 hong gong;句 ju gou;枸 gou ju;谷 gu yu;鹄 hu gu;贾 jia gu;呱 gua gua gu;栝 gua kuo;莞 guan wan;纶 lun guan;龟 gui jun qiu;柜 gui ju;炅 jiong gui;桧 gui hui;炔 que gui;鲑 gui xie;
涡 wo guo;虾 xia ha;还 huan hai;咳 ke hai;行 xing hang heng;吭 keng hang;巷 xiang hang;桁 heng hang;吓 xia he;和 he huo hu;核 he hu;貉 he hao;嘿 hei mo;虹 hong jiang;唬 hu xia;浒 hu xu;戏 xi hu;砉 hua xu;圜 yuan huan;
郇 xun huan;徊 huai hui;会 hui kuai;浍 hui kuai;溃 kui hui;豁 huo hua;嚄 huo o;奇 qi ji;缉 ji qi;稽 ji qi;期 qi ji;其 qi ji;荠 qi ji;齐 qi ji;亟 ji qi;系 xi ji;祭 ji zhai;诘 jie ji;偈 ji jie;茄 qie jia;价 jia jie;
袷 jia qia;芥 jie gai;桔 jie ju;解 jie xie;颉 jie xie;楷 kai jie;见 jian xian;犍 jian qian;槛 kan jian;浅 qian jian;铅 qian yan;将 jiang qiang;强 qiang jiang;降 jiang xiang;角 jiao jue;脚 jiao jue;嚼 jiao jue;觉 jue jiao;校 xiao jiao;
侥 jiao yao;缴 jiao zhuo;峤 jiao qiao;矜 jin guan qin;劲 jin jing;靓 jing liang;咀 ju zui;趄 ju qie;且 qie ju;瞿 qu ju;圈 quan juan;隽 juan jun;噱 jue xue;麇 jun qun;浚 jun xun;筠 yun jun;卡 ka qia;阚 kan han;壳 ke qiao;
适 shi kuo;隗 wei kui;悝 kui li;腊 la xi;落 luo la lao;络 luo lao;烙 lao luo;泷 long shuang;姥 lao mu;潦 lao liao;乐 le yue lao yao;勒 le lei;肋 lei le;了 le liao;棱 leng ling;栎 li yue;俩 lia liang;莨 lang liang;蓼 liao lu;
六 liu lu;陆 lu liu;碌 lu liu;弄 nong long;偻 lou lu;露 lu lou;率 shuai lu;捋 lu luo;泺 luo po;漯 luo ta;脉 mai mo;埋 mai man;蔓 man wan;没 mei mo;冒 mao mo;糜 mi mei;祢 mi ni;缪 mou miu miao;乜 mie nie;玟 wen min;黾 mian min;
渑 mian sheng;万 wan mo;抹 mo ma;摩 mo ma;模 mo mu;牟 mou mu;无 wu mo;那 na nei;哪 na nei ne;娜 na nuo;南 nan na;呢 ne ni;溺 ni niao;尿 niao sui;粘 zhan nian;疟 nue yao;喏 nuo re;区 qu ou;喔 o wo;迫 po pai;胖 pang pan;
拚 pan pin;朴 pu po piao;栖 qi xi;蹊 qi xi;契 qi xie;俟 si qi;茜 qian xi;荨 qian xun;纤 xian qian;慊 qian qie;鞘 qiao shao;雀 que qiao;亲 qin qing;溱 zhen qin;覃 tan qin;镡 tan xin chan;郄 qie xi;券 quan xuan;葚 shen ren;
若 ruo re;塞 sai se;色 se shai;嗄 a sha;杉 shan sha;莎 sha suo;厦 sha xia;栅 zha shan;糁 shen san;梢 shao sao;汤 tang shang;召 zhao shao;苕 shao tiao;蛸 shao xiao;折 zhe she;蛇 she yi;拾 shi she;射 she ye yi;歙 she xi;
什 shen shi;莘 shen xin;椹 shen zhen;省 sheng xing;识 shi zhi;似 si shi;氏 shi zhi;殖 zhi shi;峙 zhi shi;食 shi si;嘘 xu shi;熟 shu shou;属 shu zhu;数 shu shuo;术 shu zhu;俞 yu shu;说 shuo shui yue;忪 song zhong;宿 su xiu;
缩 suo su;拓 tuo ta;铊 ta tuo;忒 te tui;饧 xing tang;褪 tui tun;圩 wei xu;崴 wai wei;尉 wei yu;蔚 wei yu;遗 yi wei;尾 wei yi;宛 wan yuan;菀 wan yu;挝 wo zhua;洗 xi xian;铣 xi xian;削 xiao xue;邪 xie ye;叶 ye xie;
血 xue xie;荥 xing ying;吁 yu xu;窨 yin xun;咽 yan ye;殷 yin yan;烟 yan yin;芫 yuan yan;钥 yao yue;繇 yao you zhou;嗌 yi ai;熨 yun yu;粥 zhou yu;员 yuan yun;咋 za zha ze;拶 za zan;咱 zan za;奘 zang zhuang;仔 zi zai;择 ze zhai;
笮 ze zuo;扎 zha za;柞 zuo zha;着 zhe zhuo zhao;爪 zhua zhao;吱 zhi zi;转 zhuan zhuai;赚 zhuan zuan;拽 zhuai ye;僮 tong zhuang;琢 zhuo zuo;觜 zi zui;综 zong zeng
"""

READINGS = {word[0]: tuple(dict.fromkeys(word[1:].split())) for word in _LISTED.replace("\n", "").split(";")}
